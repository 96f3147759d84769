"""Secret scans: known forms, and windows of high entropy in candidate strings, with Spark expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.llm.arrays import running_total

# fixed values: the known forms, and how long a find must be
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
# both runs are as long as they can be, so a shorter one holds no longer one
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
#: Strings that may be secrets: long, with a digit and a letter.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
#: Strings that are known to be none: identifiers in a fixed layout and placeholders (see also :func:`_plain`).
ALLOWED = "^(?:[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}|(?i:.*(?:example|sample|placeholder|changeme|dummy|xxxx).*))$"
#: Longest last part of a path of plain words.
LAST_PART = 12
WINDOW = 20
#: Character classes, the narrowest first: name, form, least entropy of a window in bits per character.
CLASSES = [("hex", "^[0-9a-fA-F]+$", 3.0), ("alnum", "^[A-Za-z0-9]+$", 3.7), ("base64", "^.+$", 3.9)]
_UNIT = 1_000_000
_FIRST, _LAST = 43, 122


def bits(n: int) -> int:
    """n log2 n in millionths, so that sums are exact."""
    return round(n * math.log2(n) * _UNIT) if n else 0


def _spans(text: Column, pattern: str, kind: str, rank: int, wanted=None) -> Column:
    """(start, rank, end, kind, found) of all matches of ``pattern``, leftmost and not overlapping, that pass ``wanted``."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)
    ends = running_total(F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: (F.length(m) + F.length(g)).cast("long")))
    rows = F.zip_with(found, ends, lambda m, e: F.struct((e - F.length(m)).alias("start"), F.lit(rank).alias("rank"), e.alias("end"), F.lit(kind).alias("kind"), m.alias("found")))
    if wanted:
        rows = F.filter(rows, wanted)
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,found:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(empty)


def peak(word: Column) -> Column:
    """The greatest entropy of a window, as WINDOW * bits * millionths: one pass that adds and removes a character's count."""
    table = F.array(*[F.lit(bits(n)) for n in range(WINDOW + 2)])
    counts = F.array_repeat(F.lit(0), _LAST - _FIRST + 1)
    state = F.struct(counts.alias("n"), F.lit(0).alias("k"), F.lit(0).cast("long").alias("s"), F.lit(None).cast("long").alias("low"))
    # characters are cut apart once, so a long string costs in proportion to its length
    codes = F.transform(F.split(word, ""), lambda c: F.ascii(c) - _FIRST)
    leaving = F.slice(F.concat(F.array_repeat(F.lit(-1), WINDOW), codes), F.lit(1), F.size(codes))
    steps = F.zip_with(codes, leaving, lambda i, o: F.struct(i.alias("inn"), o.alias("out")))

    def step(a: Column, x: Column) -> Column:
        inn, out = x["inn"], x["out"]
        here, gone = F.get(a["n"], inn), F.get(a["n"], out)
        moved = a["s"] + F.get(table, here + 1) - F.get(table, here) + F.when(out >= 0, F.get(table, gone - 1) - F.get(table, gone)).otherwise(0)
        s = F.when(inn == out, a["s"]).otherwise(moved)
        n = F.transform(a["n"], lambda x, k: x + (k == inn).cast("int") - (k == out).cast("int"))
        k = a["k"] + 1
        return F.struct(n.alias("n"), k.alias("k"), s.cast("long").alias("s"), F.when(k >= WINDOW, F.least(a["low"], s)).cast("long").alias("low"))

    least = F.aggregate(steps, state, step, lambda a: a["low"])
    return F.lit(bits(WINDOW)) - least


def _plain(word: Column) -> Column:
    """A path of plain words, the last one of at most LAST_PART letters and digits. Told without a pattern that repeats
    groups: Java's matcher recurses over those."""
    path = F.translate(F.ltrim(word, F.lit("/")), "_-", "//")
    last = F.substring_index(path, "/", -1)
    head = F.substring(path, F.lit(1), F.length(path) - F.length(last))
    parts = head.rlike("^[a-z]") & ~head.rlike("[^a-z/]") & ~F.contains(head, F.lit("//"))
    return parts & ~last.rlike("[^a-z0-9]") & (F.length(last) <= LAST_PART)


def _random(word: Column) -> Column:
    need = F.lit(None)
    for _, form, level in reversed(CLASSES):
        need = F.when(word.rlike(form), F.lit(round(level * WINDOW * _UNIT))).otherwise(need)
    return word.rlike("[0-9]") & word.rlike("[A-Za-z]") & ~word.rlike(ALLOWED) & ~_plain(word) & (peak(word) >= need)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` and ``spans``: (start, rank, end, kind, found) in order, places in code points, end exclusive.

    Kinds by rank: assign, access, hex, entropy. Known forms are always
    reported; a candidate string is added as ``entropy`` if a window of
    WINDOW characters reaches its character class' least entropy, no
    allow-list form fits it, and no known form covers it. Null and empty texts have none;
    repeated rows are each scanned; an existing column ``spans`` is replaced. Nothing is shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.filter(
        F.zip_with(_spans(text, ASSIGN, "assign", 1), F.when(text.rlike(ASSIGN), keyed).otherwise(F.array().cast("array<string>")), lambda s, v: F.struct(s.alias("s"), v.alias("v"))),
        lambda x: F.length(x["v"]) >= ASSIGN_LEAST,
    )
    base = docs.withColumn("spans", F.concat(F.transform(assign, lambda x: x["s"]), _spans(text, ACCESS, "access", 2), _spans(text, HEX, "hex", 3)))
    covered = lambda s: F.exists("spans", lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
    more = _spans(text, CANDIDATE, "entropy", 4, lambda s: ~covered(s) & _random(s["found"]))
    return base.withColumn("spans", F.array_sort(F.concat("spans", more)))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
