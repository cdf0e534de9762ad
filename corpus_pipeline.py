"""From raw documents to packed training bins: five stages over the table ``documents``."""

from gustline.llm.pipeline import (
    ORACLE_SQL, STAGES, drop_near_duplicates, identify_language, mask_secrets, mix_sources, pack_bins, run,
)

__all__ = [
    "ORACLE_SQL", "STAGES", "drop_near_duplicates", "identify_language", "mask_secrets", "mix_sources", "pack_bins", "run",
]
