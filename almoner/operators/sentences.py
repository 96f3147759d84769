"""Near-identical sentences between two collections of documents."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions import text as tx
from almoner.functions.text import NON_WORD, WORD, let
from almoner.operators.skew import keyed_join, maybe_in, widen

# Fixed value: the score of an exact match.
EXACT_SCORE = 9999
MARK = "\u0001"
# About 25 MB of seed rows at most when they are broadcast.
BROADCAST_SEEDS = 250_000
#: Seeds of a source that are looked for one by one; more of them meet all texts of their length.
FEW_SEEDS = 1000


def source_sentences(df: DataFrame, source: str, text: str, marker: str | None = None) -> DataFrame:
    """``source, sentence_no, sentence, num_char_source``, lengths with one line end each.

    With ``marker`` the text is HTML and its body lies between the first and
    last marker tag.
    """
    body = tx.body_between(F.translate(F.col(text), "\n", " "), marker) if marker else F.col(text)
    listed = df.select(F.col(source).alias("source_id"), tx.sentences(body).alias("s"))
    size = F.aggregate("s", F.lit(0).cast("bigint"), lambda n, s: n + F.length(s) + 1)
    return listed.select("source_id", size.alias("num_char_source"), F.posexplode("s").alias("sentence_no", "sentence"))


def clean_candidates(df: DataFrame, source: str, hit: str, text: str) -> DataFrame:
    """``source_id, hit_id, line``: each candidate on one line, without pipes."""
    return df.select(F.col(source).alias("source_id"), F.col(hit).alias("hit_id"), F.translate(F.col(text), "\n|", " ").alias("line"))


def allowed_errors(length: Column, errors: int, per_error: int) -> Column:
    """Most edits a sentence can have and still reach ``per_error`` characters per edit.

    With L characters, c edits and a match of at most L + c characters the mean
    length per edit is at most ``(2L + 2 + c) / 2c``.
    """
    return F.least(F.lit(errors), F.floor((2 * length + 2) / (2 * per_error - 1))).cast("int")


def gram_size(errors: int, per_error: int) -> int:
    """Seed length that fits into each of c + 1 pieces of any sentence that may have c edits."""
    sizes = [6]
    for c in range(1, errors + 1):
        shortest = math.ceil((2 * per_error - 1) * c / 2 - 1)
        sizes.append(shortest // (c + 1))
    return max(1, min(sizes))


def sentence_seeds(sentences: DataFrame, q: int) -> DataFrame:
    """``source_id, sid, mode, size, allowed, gram, offset``: where each sentence must touch its match.

    c edits leave one of c + 1 disjoint parts unchanged. ``word`` parts are a
    separator and the q characters from the word start after it; a sentence
    with enough of them needs the candidates' word starts only. Others use the
    first q characters of c + 1 equal parts (``free``); sentences under q
    characters, which allow no edits, are looked up whole (``short``).
    """
    s = F.col("sentence")
    chunks = F.split(F.regexp_replace(s, rf"(?s)({NON_WORD})({WORD}.{{{q - 1}}})", f"$1{MARK}$2"), MARK)
    # a chunk after the first starts with its seed; rarer seeds, inside one word, come first
    anchored = F.transform(
        F.sequence(F.lit(2), F.size("_chunks")),
        lambda i: let(
            F.substring(F.element_at("_chunks", i), 1, q),
            lambda g: F.struct(
                F.length(F.regexp_replace(g, WORD, "")).alias("marks"),
                F.xxhash64(g).alias("order"),
                g.alias("gram"),
                F.length(F.array_join(F.slice("_chunks", F.lit(1), i - 1), "")).alias("offset"),
            ),
        ),
    )
    enough = (F.size("_chunks") - 1 > F.col("allowed")) & ~s.contains(MARK)
    part = F.floor(F.length(s) / (F.col("allowed") + 1)).cast("int")
    free = F.transform(
        F.sequence(F.lit(0), F.col("allowed")),
        lambda i: F.struct(F.substring(s, i * part + 1, F.lit(q)).alias("gram"), (i * part).alias("offset")),
    )
    word = F.transform(
        F.slice(F.array_sort(anchored), F.lit(1), F.col("allowed") + 1),
        lambda x: F.struct(x["gram"].alias("gram"), x["offset"].alias("offset")),
    )
    short = F.array(F.struct(s.alias("gram"), F.lit(0).alias("offset")))
    mode = F.when(F.length(s) < q, "short").when(enough, "word").otherwise("free")
    seeds = F.when(F.col("mode") == "short", short).when(F.col("mode") == "word", word).otherwise(free)
    return (
        sentences.withColumn("_chunks", chunks)
        .withColumn("mode", mode)
        .select("source_id", "sid", "mode", F.length(s).alias("size"), "allowed", F.explode(seeds).alias("seed"))
        .select("source_id", "sid", "mode", "size", "allowed", "seed.*")
    )


def candidate_grams(candidates: DataFrame, mode: str, q: int, lengths: list[int] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``source_id, hit_id, place, gram`` and the columns to ``keep``: texts of q characters and their zero-based place.

    The pattern consumes one character per match, so the position of a match
    in the array is the position in the line. For ``short`` the grams are the
    beginnings of the given lengths at each word start.
    """
    at_word = rf"(?<!{WORD})(?=({WORD}"
    pattern = {
        "word": rf"(?s){at_word}.{{{q - 1}}})).|.",
        "free": rf"(?s)(?=(.{{{q}}})).|.",
        "short": rf"(?s){at_word}.{{0,{max(q - 2, 0)}}})).|.",
    }[mode]
    grams = candidates.select(
        "source_id", "hit_id", *keep,
        F.posexplode(F.regexp_extract_all("line", F.lit(pattern), 1)).alias("place", "gram"),
    ).filter("gram != ''")
    if mode != "short":
        return grams
    beginnings = F.array(*[F.substring("gram", 1, k) for k in lengths or range(1, q)])
    return grams.select("source_id", "hit_id", *keep, "place", F.explode(beginnings).alias("gram"))


def seed_places(line: Column, gram: Column) -> Column:
    """Zero-based places of all occurrences of a text in a line, overlapping ones included."""
    first = F.position(gram, line)
    # more than one: the parts before, between and behind them
    parts = F.split(line, F.concat(F.lit(r"(?=\Q"), F.replace(gram, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)")))
    heads = F.slice(parts, F.lit(1), F.size(parts) - 1)
    ends = F.aggregate(heads, F.array(F.lit(0)), lambda acc, part: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(part))))
    # a line that begins with the text has no part before it
    several = F.when(F.startswith(line, gram), ends).otherwise(F.slice(ends, F.lit(2), F.size(ends)))
    return let(first, lambda at: F.when(F.position(gram, line, at + 1) == 0, F.array(at - 1)).otherwise(several))


def _begin(place: Column, allowed: Column) -> Column:
    """Where the region around a place begins; -1 is a blank before the line."""
    return F.greatest(place - allowed - 1, F.lit(-1))


def _region(line: Column, place: Column, size: Column, allowed: Column) -> Column:
    """What a match near ``place`` can touch, with a character on either side that decides about word limits."""
    begin = _begin(place, allowed)
    return F.when(begin < 0, F.concat(F.lit(" "), F.substring(line, F.lit(1), size + 3 * allowed + 2))).otherwise(
        F.substring(line, begin + 1, size + 3 * allowed + 3)
    )


def _best_window(sentence: Column, region: Column, place: Column, allowed: Column, errors: int) -> Column:
    """Best whole-word window near ``place`` of a line: ``cost, start, shorter, match``; null if none fits.

    ``errors`` bounds ``allowed``: a distance is computed no further than that, which takes time as the length, not as its square.
    """
    size, begin = F.length(sentence), _begin(place, allowed)
    is_word = lambda t, at: F.substring(t, at, F.lit(1)).rlike(WORD)

    def windows(text: Column) -> Column:
        starts = F.filter(
            F.sequence(F.greatest(place - allowed, F.lit(0)) - begin + 1, place + allowed - begin + 1),
            lambda i: is_word(text, i) & ~is_word(text, i - 1),
        )
        lengths = F.sequence(F.greatest(size - allowed, F.lit(1)), size + allowed)
        fitting = lambda i: F.filter(
            lengths,
            lambda n: (i + n - 1 <= F.length(text)) & is_word(text, i + n - 1) & ~is_word(text, i + n),
        )

        def judged(i: Column, n: Column) -> Column:
            match = F.substring(text, i, n)
            return F.struct(
                F.levenshtein(sentence, match, max(errors, 1)).alias("cost"), (i + begin - 1).alias("start"), (-n).alias("shorter"), match.alias("match")
            )

        every = F.flatten(F.transform(starts, lambda i: F.transform(fitting(i), lambda n: judged(i, n))))
        return F.array_min(F.filter(every, lambda w: w["cost"].between(0, allowed)))

    return let(region, windows)


def score_columns(df: DataFrame, sentence: str, match: str, cost: str, per_error: int) -> DataFrame:
    """Lengths with one line end each, their mean, and mean length per edit, cut to two decimals.

    Keeps exact matches and those with at least ``per_error`` characters per edit.
    """
    text, found = F.length(sentence) + 1, F.length(match) + 1
    per_cost = F.floor((text + found) * 50 / F.nullif(F.col(cost), F.lit(0))) / 100.0
    scored = df.withColumns({
        "num_char_text": text,
        "num_char_match": found,
        "mean_char": (text + found) / 2.0,
        "mean_char_per_cost": F.when(F.col(cost) <= 0, F.lit(float(EXACT_SCORE))).otherwise(per_cost),
    })
    return scored.filter((F.col(cost) <= 0) | (F.col("mean_char_per_cost") >= per_error))


def _cut(hits: DataFrame) -> DataFrame:
    return hits.filter(F.col("place") >= -F.col("allowed")).select("source_id", "sid", "hit_id", "place", _region(F.col("line"), F.col("place"), F.col("size"), F.col("allowed")).alias("region"))


def _few(candidates: DataFrame, seeds: DataFrame, broadcast: bool) -> DataFrame:
    """Regions around seeds that are looked for one by one in the lines of their source."""
    listed = seeds.groupBy("source_id").agg(F.collect_list(F.struct("sid", "size", "allowed", "gram", "offset")).alias("_seeds"))
    met = candidates.join(F.broadcast(listed), "source_id") if broadcast else keyed_join(candidates, listed, ["source_id"])
    found = met.select("source_id", "hit_id", "line", F.explode(F.filter("_seeds", lambda x: F.contains(F.col("line"), x["gram"]))).alias("_s"))
    places = found.select("source_id", "hit_id", "line", "_s.*", F.explode(seed_places(F.col("line"), F.col("_s.gram"))).alias("_at"))
    return _cut(places.withColumn("place", F.col("_at") - F.col("offset")))


def _many(candidates: DataFrame, seeds: DataFrame, q: int, small: bool) -> list[DataFrame]:
    """Regions around seeds that meet all texts of their length in the lines of their source."""
    counted = seeds.groupBy("mode", F.length("gram").alias("size")).count().collect()
    short = sorted(row["size"] for row in counted if row["mode"] == "short")
    found = sorted({row["mode"] for row in counted} - {"short"})
    # without a shuffle one pass over all places serves both kinds; otherwise word starts are far fewer
    passes = [("free", found)] if small and "free" in found else [(mode, [mode]) for mode in found]
    if short:
        passes.append(("short", ["short"]))
    out = []
    for mode, kinds in passes:
        wanted = seeds.filter(F.col("mode").isin(kinds)).drop("mode")
        # only candidates of sources that have such seeds are cut up
        sources = wanted.select("source_id").distinct()
        some = candidates.join(F.broadcast(sources) if small else sources, "source_id", "left_semi")
        near = (F.col("place") - F.col("offset")).alias("place")
        if small:
            # the line is at hand where its places meet the seeds: only regions leave it
            met = candidate_grams(some, mode, q, short, ("line",)).join(F.broadcast(wanted), ["source_id", "gram"])
            hits = met.select("source_id", "sid", "hit_id", near, "size", "allowed", "line")
        else:
            met = candidate_grams(some, mode, q, short).join(wanted, ["source_id", "gram"])
            places = met.select("source_id", "sid", "hit_id", near, "size", "allowed").distinct()
            # of the lines, those without a hit stay where they are
            marked, mark = candidates.withColumn("_line", F.xxhash64("source_id", "hit_id")), F.xxhash64("source_id", "hit_id").alias("_line")
            hits = places.join(maybe_in(marked, places.select(mark), "_line").drop("_line"), ["source_id", "hit_id"])
        out.append(_cut(hits))
    return out


def match_sentences(sentences: DataFrame, candidates: DataFrame, errors: int = 5, min_per_error: int = 15) -> DataFrame:
    """Best match of each source sentence in each candidate of the same source.

    ``sentences`` comes from :func:`source_sentences`, ``candidates`` from
    :func:`clean_candidates`. A match runs from a word start to a word end and
    has at most ``errors`` edits; least cost, then leftmost, then longest.

    Seeds of up to BROADCAST_SEEDS rows travel to the lines; what can belong to
    a match is cut out there, and only these regions are shuffled. A source's
    FEW_SEEDS are looked for one by one, more of them meet the lines' texts of
    q characters. Beyond BROADCAST_SEEDS lines are moved once: to the few seeds
    of their source, or, if they have a hit, to where its region is cut (a bit
    map takes out most others).
    """
    q = gram_size(errors, min_per_error)
    candidates = widen(candidates)
    # copies of a sentence within a source are searched once
    distinct = sentences.select("source_id", "sentence").distinct().withColumn("sid", F.md5("sentence"))
    limited = distinct.withColumn("allowed", allowed_errors(F.length("sentence"), errors, min_per_error))
    seeds = sentence_seeds(limited, q)
    # two numbers decide how seeds meet lines
    numbers = seeds.groupBy("source_id").agg(F.count("*").alias("n"))
    total, many = numbers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > FEW_SEEDS)).first()
    small = total <= BROADCAST_SEEDS
    heavy = numbers.filter(F.col("n") > FEW_SEEDS).select("source_id")
    cuts = [_few(candidates, seeds.join(heavy, "source_id", "left_anti") if many else seeds, small)]
    if many:
        cuts += _many(candidates, seeds.join(heavy, "source_id", "left_semi"), q, small)
    regions = reduce(DataFrame.unionByName, cuts)
    windows = (
        # seeds of one match agree in its place
        regions.distinct()
        .join(limited, ["source_id", "sid"])
        .select(
            "source_id", "hit_id", "sentence",
            # exploding drops what does not fit without pricing it a second time in a filter
            F.explode(F.array_compact(F.array(_best_window(F.col("sentence"), F.col("region"), F.col("place"), F.col("allowed"), errors)))).alias("best"),
        )
    )
    best = windows.groupBy("source_id", "hit_id", "sentence").agg(F.min("best").alias("best"))
    flat = best.select("source_id", "hit_id", "sentence", F.col("best.cost").alias("cost"), F.col("best.match").alias("match"))
    kept = score_columns(flat, "sentence", "match", "cost", min_per_error)
    return sentences.join(kept, ["source_id", "sentence"]).select(
        "num_char_text", "num_char_match", "mean_char", "source_id", "num_char_source", "hit_id", "cost",
        "mean_char_per_cost", F.col("sentence").alias("source_text"), F.col("match").alias("matched_text"), "sentence_no",
    )
