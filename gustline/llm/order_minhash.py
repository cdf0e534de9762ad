"""Order MinHash fingerprints: sensitive to the order of a text, not only to its parts.

After Marcais et al. 2019, "Locality-sensitive hashing for the edit distance": k-mers carry
their occurrence number, so that repeats differ; the smallest ones by a hash are selected,
kept in text order, and the tuple is hashed. One hash serves all sketches: its top bits deal
the k-mers into 2^BIN_BITS bins, and every bin's TUPLE smallest k-mers are one sketch; a bin
with one k-mer borrows the smallest of the next filled bin. k-mers are runs of K words. Everything is a column expression over one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gustline.llm.common import fresh
from gustline.session import stage

K = 3
TUPLE = 2
BIN_BITS = 6
#: Longer words (and scripts without blanks) are cut into pieces of this many code points.
WORD_PIECE = 16
_PLACE_BITS = 26  # the low bits of a packed number hold a place, the others a hash
_PLACE = (1 << _PLACE_BITS) - 1
_SPACE = r"\x20\x09-\x0D"


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_PLACE))


def _hash(x: Column) -> Column:
    return x.bitwiseAND(F.lit(~_PLACE))


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BIN_BITS)


def _words(text: Column) -> Column:
    long_run = f"[^{_SPACE}]{{{WORD_PIECE + 1}}}"
    cut = F.regexp_replace(text, f"([^{_SPACE}]{{{WORD_PIECE}}})(?=[^{_SPACE}])", "$1 ")
    pieces = F.split(F.when(text.rlike(long_run), cut).otherwise(text), f"[{_SPACE}]+")
    return F.filter(pieces, lambda w: w != "")


def _kmers(words: Column, k: int) -> Column:
    """Sorted hashes of all runs of ``k`` words with their places."""

    def runs(h: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(k)))
        )
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= k, each).otherwise(whole)

    hashes = _bind(F.transform(words, lambda w: F.xxhash64(w)), runs)
    return F.sort_array(F.transform(hashes, lambda x, i: _hash(x).bitwiseOR(_place(i.cast("long")))))


def _numbered(sorted_kmers: Column) -> Column:
    """Hashes of (k-mer, occurrence number) with the k-mers' places, sorted.

    Equal k-mers stand together, in text order. A repeat's number is its distance from the
    first of them, which a binary search finds.
    """

    def rows(s: Column) -> Column:
        steps = F.transform(
            F.sequence(F.ceil(F.log2(F.size(s) + 1)).cast("int"), F.lit(0), F.lit(-1)), lambda e: F.pow(F.lit(2), e).cast("int")
        )

        def number(x: Column, i: Column, steps: Column) -> Column:
            first = F.aggregate(
                steps, F.lit(0),
                lambda at, step: F.when(
                    (at + step <= i) & (F.get(s, at + step - 1) < _hash(x)), at + step
                ).otherwise(at),
            )
            return F.when((i > 0) & (_hash(F.get(s, i - 1)) == _hash(x)), i - first).otherwise(0)

        def each(steps: Column) -> Column:
            return F.transform(
                s, lambda x, i: _hash(F.xxhash64(_hash(x), number(x, i, steps))).bitwiseOR(_place(x))
            )

        return _bind(steps, each)

    return F.sort_array(_bind(sorted_kmers, rows))


def fingerprint(text: Column, k: int = K) -> Column:
    """array<bigint>: bin number times 2^32 plus the 32-bit hash of the bin's tuple, for every
    bin that has k-mers, by bin. Texts without words (NULL, empty, blank) have no bins; those
    of fewer than ``k`` words have one k-mer, which is hashed alone; every sketch of a text
    with two k-mers or more holds two in their order. Equal texts have equal fingerprints.
    Long texts are read whole; one of more than 2^26 words raises an error, as their places would
    not fit beside the hashes."""

    def sketch(n: Column) -> Column:
        # bins stand together, their smallest first
        return F.filter(n, lambda x, i: (i < TUPLE) | (_bin(F.get(n, i - TUPLE)) != _bin(x)))

    def tuples(s: Column) -> Column:
        def value(x: Column, i: Column) -> Column:
            first = (i == 0) | (_bin(F.get(s, i - 1)) != _bin(x))
            # of a bin with one k-mer, the next filled bin's smallest; after the last, the first's
            other = F.get(s, (i + 1) % F.size(s))
            pair = F.when(
                _place(x) < _place(other), F.xxhash64(_hash(x), _hash(other))
            ).otherwise(F.xxhash64(_hash(other), _hash(x)))
            hashed = F.when(F.size(s) > 1, pair).otherwise(F.xxhash64(_hash(x)))
            return F.when(first, F.shiftleft(_bin(x), 32).bitwiseOR(hashed.bitwiseAND(F.lit(0xFFFFFFFF))))

        return F.sort_array(F.filter(F.transform(s, value), lambda x: x.isNotNull()))

    def sketches(words: Column) -> Column:
        many = F.raise_error(F.concat(F.lit("a text has too many words: "), F.size(words).cast("string")))
        found = _bind(_bind(_numbered(_kmers(words, k)), sketch), tuples)
        return F.when(F.size(words) > _PLACE, many.cast("array<bigint>")).otherwise(found)

    return _bind(_words(F.coalesce(text, F.lit(""))), sketches)


def text_of(sketches: Column) -> Column:
    """The fingerprint as text: ten hexadecimal digits per bin."""
    return F.lower(F.array_join(F.transform(sketches, lambda x: F.lpad(F.hex(x), 10, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches among bins that either fingerprint fills; 1 if neither fills any."""

    def bins(s: Column) -> Column:
        return F.transform(s, lambda x: F.shiftright(x, 32))

    filled = F.size(F.array_union(bins(a), bins(b)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / filled)


def with_next(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (unique ``keys``, ...) with next_<key> columns: the keys that follow in order,
    after the last the first.

    Ranges are sorted by many tasks; only each range's first row meets the others.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (part,) = fresh("part")
    ranged = stage(rows.repartitionByRange(n, *keys).withColumn(part, F.spark_partition_id()), "ranges")
    key = F.struct(*keys)
    heads = ranged.groupBy(part).agg(F.min(key).alias("head"))
    order = Window.orderBy(part)
    over = heads.select(
        F.col(part).alias("of"), F.coalesce(F.lead("head").over(order), F.min("head").over(Window.partitionBy())).alias("over")
    )
    inside = F.lead(key).over(Window.partitionBy(part).orderBy(*keys))
    joined = ranged.withColumn("follows", inside).join(over, F.col(part) == F.col("of"))
    following = F.coalesce("follows", "over")
    return joined.select(*rows.columns, *(following[k].alias(f"next_{k}") for k in keys))


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Per document: key, n_chars, edited_text, sketches, edited_sketches, next_sketches.

    The edited text is the document's with its last floor(n_chars / 2) code points replaced by
    the first as many (or all) of the next document's, by ascending key, after the last the
    first. NULL keys come last; rows with equal keys follow by their texts' hashes, and
    repeated rows (equal key and text) count as one document and have equal results. NULL
    texts are empty; other columns are not read; an empty table gives an empty table.

    Places in the order are found from keys alone. Texts are shuffled once by key; of the
    next document only the part that is needed is sent, with its fingerprint.
    """
    base = docs.select(
        F.col(key).isNull().alias("none"), F.coalesce(F.col(key), F.lit(0)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    ).withColumn("h", F.xxhash64("body"))
    keys = ["none", "id", "h"]
    ids = base.select(*keys, F.length("body").alias("n")).groupBy(*keys).agg(F.max("n").alias("n"))
    order = with_next(ids, keys)
    whole = base.withColumn("sketches", fingerprint(F.col("body"), k))
    need = F.floor(F.col("n") / 2).cast("int")
    wanted = order.select(*(F.col(f"next_{c}").alias(c) for c in keys), *(F.col(c).alias(f"own_{c}") for c in keys), need.alias("need"))
    sent = whole.join(wanted, keys).select(
        *(F.col(f"own_{c}").alias(c) for c in keys), F.expr("substring(body, 1, need)").alias("tail"),
        F.col("sketches").alias("next_sketches"),
    )
    one = sent.groupBy(*keys).agg(F.first("tail").alias("tail"), F.first("next_sketches").alias("next_sketches"))
    n = F.length("body")
    kept = F.substring(F.col("body"), F.lit(1), (n - F.floor(n / 2)).cast("int"))
    return (
        whole.join(one, keys)
        .select(
            F.when(~F.col("none"), F.col("id")).alias(key), n.cast("long").alias("n_chars"),
            F.concat(kept, "tail").alias("edited_text"), "sketches", "next_sketches",
        )
        .withColumn("edited_sketches", fingerprint(F.col("edited_text"), k))
    )


def digest(compared: DataFrame, key: str = "doc_id") -> DataFrame:
    return compared.select(
        key, "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), text_of(F.col("sketches")).alias("fingerprint"),
        text_of(F.col("edited_sketches")).alias("edited_fingerprint"),
        likeness(F.col("sketches"), F.col("edited_sketches")).alias("near_edited"),
        likeness(F.col("sketches"), F.col("next_sketches")).alias("near_next"),
    )
