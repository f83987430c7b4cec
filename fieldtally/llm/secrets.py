"""Secret scan in DataFrame expressions only: three base patterns, and sliding-window entropy over candidate strings.

A candidate is a longest run of the characters of a class. A window of fixed width slides over it; counts of its characters
are updated by the one that enters and the one that leaves, and the sum of c * log2(c) with them, in whole millionths, so
that nothing drifts. A window is hot if its Shannon entropy reaches the class's bound. Overlapping hot windows are one
span. The allow-list leaves a candidate out if each of its segments, between ``SEPARATORS``, is plain: a word of small letters that
may begin with a capital, or one of capitals, of at most ``LONGEST_WORD`` letters and two digits, a number, or a word with "example" in
it. A candidate with another segment, such as a path or slug with a key in it, is scanned as a whole.

Positions are code points, ends exclusive. They follow from the pieces between the matches, whose lengths are added up.

Patterns have no repeated groups, and work on runs of any length. Defined results: a null text is an empty text and has no spans. Ties in start go by the order of the kinds. Rows with equal
identifiers are scanned one by one. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, let

UNIT = 1_000_000


def any_case(word: str) -> str:
    """A pattern for the word with ASCII letters in either case, the same in every regex dialect."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEYWORDS = "|".join(map(any_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")
SEPARATORS = "[/_+=-]"
LONGEST_WORD = 20
# A segment that tells nothing: a word by its case shape and length, a number, or a marked example. No repeated groups: the regex
# engine would recurse once for each repetition.
PLAIN = (
    f"^([A-Z]?[a-z]{{0,{LONGEST_WORD}}}|[A-Z]{{0,{LONGEST_WORD}}})[0-9]{{0,2}}$|^[0-9]+$"
    f"|^[A-Za-z]{{0,{LONGEST_WORD}}}{any_case('example')}[A-Za-z]{{0,{LONGEST_WORD}}}[0-9]{{0,4}}$"
)


@dataclass(frozen=True)
class CharClass:
    """Characters of a candidate, the window's width, and the entropy in bits from which a window is hot."""

    kind: str
    pattern: str
    alphabet: str
    width: int
    bits: float

    @property
    def most(self) -> int:
        """Largest sum of c * log2(c), in millionths, that a hot window can have."""
        return int(self.width * (log2(self.width) - self.bits) * UNIT)


CLASSES = (
    CharClass("entropy_hex", "[0-9a-fA-F]{24,}", "0123456789abcdefABCDEF", 24, 3.1),
    CharClass(
        "entropy_base64",
        "[A-Za-z0-9+/_=-]{24,}",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        24,
        4.05,
    ),
)


def terms(width: int) -> list[int]:
    """c * log2(c) in millionths for the counts 0 to ``width``."""
    return [0, *(round(c * log2(c) * UNIT) for c in range(1, width + 1))]


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, found>> of the leftmost non-overlapping matches, which must not be empty strings."""

    def placed(found: Column) -> Column:
        return let(
            F.transform(F.split(text, pattern, -1), F.length),
            lambda gaps: F.aggregate(
                F.transform(found, lambda m, i: F.struct(F.get(gaps, i).alias("gap"), m.alias("found"))),
                F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,found:string>>").alias("out")),
                lambda s, m: F.struct(
                    (s["at"] + m["gap"] + F.length(m["found"])).alias("at"),
                    F.concat(s["out"], F.array(F.struct((s["at"] + m["gap"]).alias("start"), m["found"].alias("found")))).alias("out"),
                ),
                lambda s: s["out"],
            ),
        )

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(
        F.array().cast("array<struct<start:int,found:string>>")
    )


def spans_of(kind: str, rank: int, found: Column) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (m["start"] + F.length(m["found"])).alias("end")),
    )


def hot_spans(of: CharClass, rank: int, found: Column, plain: str) -> Column:
    """Spans of the hot windows of the candidates, overlapping ones joined."""
    state = "struct<counts:array<int>,sum:bigint,out:array<struct<start:int,rank:int,kind:string,end:int>>>"
    table = F.array(*map(F.lit, terms(of.width)))
    width = of.width

    def slide(start: Column, codes: Column, cost: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            enters = F.get(codes, i)
            leaves = F.when(i >= width, F.get(codes, i - width)).otherwise(F.lit(0))
            c_in, c_out = F.coalesce(F.get(s["counts"], enters), F.lit(0)), F.coalesce(F.get(s["counts"], leaves), F.lit(0))
            moved = (enters != leaves) & (i >= width)
            change = (
                F.when(i < width, F.get(cost, c_in + 1) - F.get(cost, c_in))
                .when(moved, F.get(cost, c_in + 1) - F.get(cost, c_in) + F.get(cost, c_out - 1) - F.get(cost, c_out))
                .otherwise(F.lit(0))
            )
            counts = F.transform(
                s["counts"],
                lambda c, k: c + F.when(k == enters, 1).otherwise(0) - F.when((i >= width) & (k == leaves), 1).otherwise(0),
            )
            end = start + i + 1
            fresh = F.struct((end - width).alias("start"), F.lit(rank).alias("rank"), F.lit(of.kind).alias("kind"), end.alias("end"))

            def add(out: Column) -> Column:
                last = F.get(out, F.size(out) - 1)
                joined = F.struct(last["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(of.kind).alias("kind"), end.alias("end"))
                return F.when(
                    (F.size(out) > 0) & (last["end"] > end - width),
                    F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(joined)),
                ).otherwise(F.concat(out, F.array(fresh)))

            return let(
                s["sum"] + change,
                lambda total: F.struct(
                    counts.alias("counts"),
                    total.alias("sum"),
                    F.when((i >= width - 1) & (total <= of.most), add(s["out"])).otherwise(s["out"]).alias("out"),
                ),
            )

        empty = F.struct(
            F.array_repeat(F.lit(0), len(of.alphabet) + 1).alias("counts"),
            F.lit(0).cast("long").alias("sum"),
            F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>").alias("out"),
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), empty.cast(state), lambda s, i: step(s, i).cast(state), lambda s: s["out"])

    def suspicious(m: Column) -> Column:
        return F.exists(F.split(m["found"], SEPARATORS, -1), lambda s: ~s.rlike(plain))

    def one(m: Column) -> Column:
        codes = F.transform(F.split(m["found"], ""), lambda c: F.instr(F.lit(of.alphabet), c))
        return let(F.struct(codes.alias("codes"), table.cast("array<bigint>").alias("cost")), lambda x: slide(m["start"], x["codes"], x["cost"]))

    return F.flatten(F.transform(F.filter(found, suspicious), one))


def shown(spans: Column) -> Column:
    """kind:start:end by start and kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", classes: tuple[CharClass, ...] = CLASSES, plain: str = PLAIN
) -> DataFrame:
    """(doc_id, assign, access, hex, entropy: arrays of struct<start, rank, kind, end>) for every row of ``docs``.

    ``plain`` is the pattern of segments that the allow-list takes for harmless.
    """
    rows = id_and_text(docs, doc_id, text)
    column = F.col("text")
    assigned = F.filter(matches(column, ASSIGN), lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2)) >= 6)
    entropy = [hot_spans(c, len(BASE_KINDS) + i, matches(column, c.pattern), plain) for i, c in enumerate(classes)]
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    return rows.select(
        "doc_id",
        spans_of("assign", 0, assigned).alias("assign"),
        spans_of("access", 1, matches(column, ACCESS)).alias("access"),
        spans_of("hex", 2, matches(column, HEX)).alias("hex"),
        (F.concat(*entropy) if entropy else none).alias("entropy"),
    )


def scan_report(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans as text, one row for each row of ``secret_scan``."""
    base = F.concat("assign", "access", "hex")
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.concat(base, F.col("entropy"))).alias("spans"),
    )
