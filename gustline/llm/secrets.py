"""Secret scans: fixed patterns, and sliding-window entropy of candidate strings.

Everything is a column expression over one row: no shuffle, no Python. Spans come from the
pieces between matches: ``split`` and ``regexp_extract_all`` walk a text in the same way, so
running sums of both lengths give every match's place in code points. The work is nearly in
proportion to a text's length, however long its candidates are or many its matches.
"""

from __future__ import annotations

from dataclasses import dataclass
import math

from pyspark.sql import Column, DataFrame, functions as F

from gustline.llm.common import bind, fresh, running

#: The base patterns. The last number is the least length of the group.
ASSIGN = (
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))


@dataclass(frozen=True)
class CharClass:
    """Candidate strings over one class of characters."""

    kind: str
    pattern: str  # a run that can't start or end inside a longer run of the class
    window: int
    bits: float  # least entropy of a window, in bits a character
    needs: tuple[str, ...]  # patterns a candidate must contain


#: A random string of 20 hexadecimal digits has 3.4 bits a character on average, one of 20
#: base-64 characters 4.1; words and identifiers of that length lie near 3. Of random strings of
#: 20 characters, these reach the bits: base 36 99%, base 32 98%, letters of both cases 95%, of
#: one case 67% (long words come too near for less).
CLASSES = (
    CharClass("entropy_hex", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{24,}(?![0-9A-Za-z])", 24, 3.0, (r"[0-9]", r"[A-Fa-f]")),
    CharClass("entropy_base64", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}={0,2}(?![A-Za-z0-9+/])", 20, 3.6, (r"[0-9]", r"[a-z]", r"[A-Z]")),
    CharClass("entropy_urlsafe", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_-])", 20, 3.6, (r"[0-9]", r"[a-z]", r"[A-Z]")),
    CharClass("entropy_one_case", r"(?<![A-Za-z0-9])(?:[a-z0-9]{20,}|[A-Z0-9]{20,})(?![A-Za-z0-9])", 20, 3.4, (r"[0-9]", r"[A-Za-z]")),
    CharClass("entropy_letters", r"(?<![A-Za-z0-9])[A-Za-z]{20,}(?![A-Za-z0-9])", 20, 3.7, (r"[a-z]", r"[A-Z]")),
    CharClass("entropy_one_case_letters", r"(?<![A-Za-z0-9])(?:[a-z]{20,}|[A-Z]{20,})(?![A-Za-z0-9])", 20, 3.6, ()),
)
#: Code points of the pieces that a text is cut into for masking.
CHUNK = 4096
#: A window's counts: BITS for each character, PLACES of them in one number.
BITS, PLACES = 5, 12
#: Candidates that are no secrets as a whole: identifiers, image data, names with a number.
ALLOW = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"^(iVBORw0KGgo|R0lGOD|/9j/)",
    r"^[A-Za-z]+(?:[-_/][A-Za-z]+)*+[-_/]?[0-9]{1,4}$",
)
#: Placeholders and counting strings: a window that holds one is no evidence of a secret.
HARMLESS = (
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]?(?:key|token|secret)"
    r"|0123456789|abcdefgh|deadbeef|(.)\1{7}"
)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, size, match>>: places of all matches, size the group's length."""
    lit = F.lit(pattern)
    found = F.arrays_zip(
        F.regexp_extract_all(text, lit, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, lit, F.lit(group)).alias("part"),
        F.split(text, pattern, -1).alias("gap"),
    )
    kept = F.filter(found, lambda x: x["match"].isNotNull())
    placed = running(kept, lambda x: F.length(x["gap"]) + F.length(x["match"]), lambda a, b: a + b)

    def span(x: Column) -> Column:
        start, item = x["before"] + F.length(x["item"]["gap"]), x["item"]
        return F.struct(
            start.alias("start"), (start + F.length(item["match"])).alias("end"),
            F.length(item["part"]).alias("size"), item["match"].alias("match"),
        )

    none = F.array().cast("array<struct<start:int,end:int,size:int,match:string>>")
    return F.when(text.rlike(pattern), F.transform(placed, span)).otherwise(none)


def _base(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    order = [k[0] for k in BASE].index(kind)
    # runs of hexadecimal letters make up much of any text: only long ones are placed.
    # A run is matched whole either way, so this changes no result.
    quick = {"hex": HEX[:-1] + f"{{{least},}}", "access": ACCESS[:-1] + f"{{{least - 4},}}"}.get(kind, pattern)
    kept = F.filter(_matches(text, quick, group), lambda x: x["size"] >= least)
    return F.transform(kept, lambda x: _span(x, kind, order))


def _span(x: Column, kind: str, order: int) -> Column:
    return F.struct(
        x["start"].alias("start"), F.lit(order).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")
    )


def window_entropy(candidate: Column, window: int, least: float, harmless: str = HARMLESS) -> Column:
    """struct<best, first, last, clean>: the largest entropy (bits a character) of any window of
    ``window`` characters, from where to where windows reach ``least`` (-1 if none does), and
    whether one of those holds no match of ``harmless``.

    Counts move with the window: the entering character raises its count, the leaving one
    lowers its, and the sum of c * log2(c) follows by the two differences. A character is its
    place in the list of the candidate's distinct characters; the counts stand side by side in
    a few whole numbers, BITS for each, so a step changes two digits and copies little. The list is
    made once for a candidate, so the work is in proportion to its length.
    """
    if window >= 1 << BITS:
        raise ValueError(f"windows have fewer than {1 << BITS} characters")
    gain = F.array(*(F.lit(0.0 if c == 0 else (c + 1) * math.log2(c + 1) - c * math.log2(c)) for c in range(window)))
    power = F.array(*(F.lit(1 << (BITS * i)) for i in range(PLACES)))
    shifts = F.array(*(F.lit(BITS * i) for i in range(PLACES)))

    def count(counts: Column, mark: Column) -> Column:
        digits = F.get(counts, F.floor(mark / PLACES).cast("int"))
        return F.call_function("shiftright", digits, F.get(shifts, mark % PLACES)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    def slide(marks: Column, known: Column, kinds: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0).cast("long"), F.floor(kinds / PLACES).cast("int") + 1).alias("counts"),
            F.lit(0.0).alias("sum"), F.lit(-1.0).alias("best"), F.lit(-1).alias("first"), F.lit(-1).alias("last"),
            F.lit(False).alias("clean"), F.lit(0).alias("next"), F.lit(-1).alias("held"),
        )

        def step(s: Column, i: Column) -> Column:
            comes = F.get(marks, i)
            goes = F.when(i >= window, F.get(marks, i - window)).otherwise(-1)
            less = F.when(goes >= 0, F.get(gain, count(s["counts"], goes) - 1)).otherwise(0.0)
            now = count(s["counts"], comes) - F.when(comes == goes, 1).otherwise(0)
            total = s["sum"] - less + F.get(gain, now)
            bits = F.lit(math.log2(window)) - total / window
            full = i >= window - 1
            hit = full & (bits >= least - 1e-9)
            ahead = F.get(known, s["next"])  # the harmless match that ends here or later
            passed = F.coalesce(ahead["end"] == i + 1, F.lit(False))
            held = F.when(passed, ahead["start"]).otherwise(s["held"])

            def one(mark: Column, j: Column) -> Column:
                return F.when((mark >= 0) & (F.floor(mark / PLACES) == j), F.get(power, mark % PLACES)).otherwise(0)

            counts = F.transform(s["counts"], lambda c, j: c + one(comes, j) - one(goes, j))
            return F.struct(
                counts.alias("counts"), total.alias("sum"),
                F.when(full & (bits > s["best"]), bits).otherwise(s["best"]).alias("best"),
                F.when(hit & (s["first"] < 0), i - window + 1).otherwise(s["first"]).alias("first"),
                F.when(hit, i + 1).otherwise(s["last"]).alias("last"),
                (s["clean"] | (hit & (held <= i - window))).alias("clean"),
                F.when(passed, s["next"] + 1).otherwise(s["next"]).alias("next"), held.alias("held"),
            )

        return F.aggregate(
            F.sequence(F.lit(0), F.size(marks) - 1), start, step,
            lambda s: F.struct(*(s[n].alias(n) for n in ("best", "first", "last", "clean"))),
        )

    # bind what every step reads: lambda variables, not expressions that it would repeat
    def marked(chars: Column) -> Column:
        return bind(F.array_distinct(chars), lambda kinds: bind(
            F.transform(chars, lambda c: F.array_position(kinds, c).cast("int") - 1),
            lambda marks: bind(_matches(candidate, harmless), lambda known: slide(marks, known, F.size(kinds))),
        ))

    return bind(F.filter(F.split(candidate, ""), lambda c: c != ""), marked)


def _entropy(text: Column, spec: CharClass, order: int, allow: tuple[str, ...], harmless: str) -> Column:
    def candidate(x: Column) -> Column:
        ok = F.lit(True)
        for need in spec.needs:
            ok &= x["match"].rlike(need)
        for pattern in allow:
            ok &= ~x["match"].rlike(pattern)
        return ok

    scored = F.transform(
        F.filter(_matches(text, spec.pattern), candidate),
        lambda x: F.struct(x["start"].alias("start"), window_entropy(x["match"], spec.window, spec.bits, harmless).alias("w")),
    )
    return F.transform(
        F.filter(scored, lambda x: x["w"]["clean"]),
        lambda x: F.struct(
            (x["start"] + x["w"]["first"]).alias("start"), F.lit(order).alias("rank"),
            (x["start"] + x["w"]["last"]).alias("end"), F.lit(spec.kind).alias("kind"),
        ),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scan(docs: DataFrame, text: str = "text", classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW, harmless: str = HARMLESS, names: tuple[str, str] = ("base_spans", "spans")) -> DataFrame:
    """``docs`` with base_spans and spans: array<struct<start, rank, end, kind>>, in text order.

    Places are code points from 0, ends exclusive. ``base_spans`` has the three fixed kinds;
    ``spans`` has those and windows of high entropy inside candidate strings that the allow
    list does not know (it never suppresses a base span): from the first such window to the
    last, unless every one of them holds a ``harmless`` match. NULL and empty texts have no spans;
    long texts are scanned whole; repeated rows and other columns stay as they are. Columns
    of ``docs`` that have one of ``names`` are replaced.
    """
    (whole,) = fresh("text")
    kinds = [_base(F.col(whole), *spec) for spec in BASE]
    more = [_entropy(F.col(whole), spec, len(BASE) + i, allow, harmless) for i, spec in enumerate(classes)]
    return (
        docs.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
        .withColumn(names[0], F.array_sort(F.concat(*kinds)))
        .withColumn(names[1], F.array_sort(F.concat(F.col(names[0]), *more)))
        .drop(whole)
    )


def digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: key, n_assign, n_access, n_hex, base_sha256, spans (as text)."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        key, *(count(k[0]) for k in BASE),
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


def mask(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark``; overlapping spans by one mark.

    A NULL text stays NULL, a text without spans stays as it is, all columns keep their names.
    """
    base, spans = fresh("base", "spans")
    scanned = scan(docs, text, names=(base, spans), **options)
    text_ = F.col(text)

    def replaced(chunks: Column) -> Column:
        def cut(start: Column, end: Column) -> Column:
            first, last = F.floor(start / CHUNK).cast("int"), F.floor(F.greatest(end - 1, start) / CHUNK).cast("int")
            near = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
            return F.substring(near, start - first * CHUNK + 1, end - start)

        def pieces(placed: Column) -> Column:
            marks = F.transform(placed, lambda x: F.when(x["item"]["start"] < x["before"], F.lit("")).otherwise(
                F.concat(cut(x["before"], x["item"]["start"]), F.lit(mark))
            ))
            return F.concat(F.array_join(marks, ""), cut(F.array_max(F.transform(F.col(spans), lambda x: x["end"])), F.length(text_)))

        # before a span: the largest end of those that come earlier
        return bind(running(F.col(spans), lambda x: x["end"], lambda a, b: F.greatest(a, b)), pieces)

    masked = bind(F.regexp_extract_all(text_, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), replaced)
    return scanned.withColumn(text, F.when(F.size(spans) > 0, masked).otherwise(text_)).drop(base, spans)
