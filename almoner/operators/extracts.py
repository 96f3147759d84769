"""Record selection: predicates, samples, lookups, joined project extracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions.text import scrub


def not_null(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def any_not_null(*columns: str) -> Column:
    return F.coalesce(*columns).isNotNull()


def text_length(*columns: str) -> Column:
    """Characters of the non-null parts together."""
    return F.length(F.concat_ws("", *columns))


def length_between(length: Column, low: int, high: int) -> Column:
    """``low`` is inside the range, ``high`` is not."""
    return (length >= low) & (length < high)


def matches_ci(column: str, regex: str) -> Column:
    """Unanchored, case-insensitive regular expression."""
    return F.col(column).rlike(f"(?i){regex}")


def has_code(column: str, codes: str | list[str]) -> Column:
    """One of several codes, compared as text; ``"5 6 8"`` names three."""
    return F.col(column).cast("string").isin(codes.split() if isinstance(codes, str) else codes)


def apply_optional(df: DataFrame, *predicates: Column | None) -> DataFrame:
    """Filter by the predicates that are given."""
    return reduce(lambda d, p: d.filter(p), [p for p in predicates if p is not None], df)


#: Samples of so many rows are taken from the tasks' first rows; the cut of larger ones is found by counting.
FEW_ROWS = 10_000
_DIGITS, _WHOLE = 4, 32


def _cut(draws: DataFrame, n: int) -> tuple[str, int] | None:
    """The draw of the n-th row in order, and how many rows with that very draw belong to the first n; none if all rows do.

    Rows are counted by the first digits of their draw, then those of the
    group with the n-th row by the next ones. The driver gets 65,536 counts a
    round, and in the end the draws of FEW_ROWS rows at most.
    """
    known, left = "", n
    while len(known) < _WHOLE:
        group = F.substring("draw", 1, len(known) + _DIGITS).alias("group")
        for group, count in sorted(tuple(r) for r in draws.filter(F.startswith("draw", F.lit(known))).groupBy(group).count().collect()):
            if left <= count:
                break
            left -= count
        else:
            return None
        known = group
        if count <= FEW_ROWS:
            values = sorted(r["draw"] for r in draws.filter(F.startswith("draw", F.lit(known))).collect())
            return values[left - 1], left - values.index(values[left - 1])
    return known, left


def sample_records(
    df: DataFrame,
    n: int,
    key: str = "record_id",
    length: tuple[int, int] | None = None,
    donor: str | None = None,
    sector: str | None = None,
    seed: int = 0,
    code: str = "activity_code",
    texts: tuple[str, ...] = ("title", "short_description", "long_description"),
) -> DataFrame:
    """Exactly ``min(n, rows)`` records, uniformly, after the optional filters.

    The order is a digest of key and seed: random, yet the same on every run
    and when a lost executor's tasks are repeated. For more than FEW_ROWS
    records the last digest is found by counting, and rows are filtered where
    they lie and sorted by all tasks. Of rows that share the last key any will do.
    """
    measured = df.withColumn("length", text_length(*texts))
    kept = apply_optional(
        measured.filter(not_null(code) & any_not_null(*texts)),
        length_between(F.col("length"), *length) if length else None,
        matches_ci("donor", donor) if donor else None,
        matches_ci("sector", sector) if sector else None,
    )
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    if n <= FEW_ROWS:
        return kept.orderBy(draw, key).limit(n)
    cut = _cut(kept.select(draw.alias("draw")), n)
    if cut:
        kept = kept.filter(draw < cut[0]).unionByName(kept.filter(draw == cut[0]).limit(cut[1]))
    return kept.orderBy(draw, key)


def lookup(records: DataFrame, ids: DataFrame, id_column: str, key: str = "geonameid") -> DataFrame:
    """All records whose key occurs among the ids; ids may repeat or be unknown.

    Records of a table bucketed by the key stay where they are.
    """
    wanted = ids.select(F.col(id_column).cast(records.schema[key].dataType).alias(key)).distinct()
    return records.join(wanted, key, "left_semi")


#: Ranges of keys in one filter.
RANGES = 64


def key_ranges(ids: list, most: int = RANGES) -> list[tuple]:
    """Ranges that hold all keys, at most so many: parted at the widest gaps between neighbours."""
    keys = sorted(set(ids))
    if not keys:
        return []
    wide = sorted(range(1, len(keys)), key=lambda i: (keys[i - 1] - keys[i], i))[: most - 1]
    cuts = [0, *sorted(wide), len(keys)]
    return [(keys[a], keys[b - 1]) for a, b in zip(cuts, cuts[1:], strict=False)]


def lookup_few(records: DataFrame, ids: list, key: str = "geonameid") -> DataFrame:
    """Records of a few whole-number keys (thousands at most), without a join.

    The keys' ranges reach the files' statistics, so of a table stored by key
    (:func:`almoner.sources.delimited.store_by_key`) only what can hold them is read. Null keys have no records.
    """
    keys = [int(i) for i in ids if i is not None]
    if not keys:
        return records.limit(0)
    near = reduce(lambda a, b: a | b, [F.col(key) == low if low == high else F.col(key).between(low, high) for low, high in key_ranges(keys)])
    return records.filter(near & F.col(key).isin(sorted(set(keys))))


def list_distinct(df: DataFrame, keys: list[str], column: str, name: str, sep: str = "|") -> DataFrame:
    """Distinct non-null values per key, ascending, joined to one text.

    Repeats are dropped before the values of a key come together.
    """
    unique = df.select(*keys, column).dropDuplicates()
    return unique.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(column)), sep).alias(name))


# The field that holds purpose codes, and the amount type of commitments.
PURPOSE_FIELD = 4735940
COMMITMENT = "1"


def project_extract(t: dict[str, DataFrame], purpose_prefix: str | None = None, before_year: int | None = None) -> DataFrame:
    """One line per project, purpose code, classification and commitment.

    Optionally only purpose codes that begin with ``purpose_prefix``, or
    projects of years before ``before_year``.

    ``t`` holds project, custom_field_value, code_round, purpose_code,
    code_round_crs_code, crs_code, recipient, donor and project_amount. Codes,
    field values and amounts are reduced to their distinct values per project
    before they meet, so no product of repeats is ever built.
    """
    rounds = (
        t["code_round"].filter("is_master")
        .select(F.col("id").alias("round_id"), "project_id", "purpose_code_id")
        .join(t["purpose_code"].select(F.col("id").alias("purpose_code_id"), F.col("code").alias("purpose_code")), "purpose_code_id")
    )
    links = t["code_round_crs_code"].select(F.col("code_round_id").alias("round_id"), "crs_code_id")
    activities = t["crs_code"].select(F.col("id").alias("crs_code_id"), F.col("code").alias("activity_code"))
    codes = list_distinct(
        rounds.join(links, "round_id").join(activities, "crs_code_id"),
        ["project_id", "purpose_code"], "activity_code", "activity_codes",
    )
    purposes = (
        t["custom_field_value"].filter(F.col("field_id") == PURPOSE_FIELD)
        .select("project_id", F.col("value").alias("crs_purpose_code")).distinct()
    )
    amounts = (
        t["project_amount"].filter(F.col("amount_type_id").cast("string") == COMMITMENT)
        .select("project_id", F.col("value").alias("commitment_current_usd")).distinct()
    )
    party = lambda role: t[role].select(*[F.col(c).alias(f"{role}_{c}") for c in ("id", "name", "iso3")])
    project = apply_optional(t["project"].withColumnRenamed("id", "project_id"), F.col("year") < before_year if before_year else None)
    purposes = apply_optional(purposes, F.col("crs_purpose_code").startswith(purpose_prefix) if purpose_prefix else None)
    texts = [scrub(F.col(c)).alias(c) for c in ("title", "short_description", "long_description")]
    return (
        project.join(party("recipient"), "recipient_id")
        .join(party("donor"), "donor_id")
        .join(purposes, "project_id")
        .join(codes, "project_id")
        .join(amounts, "project_id")
        .select(
            "project_id", "donor_project_id", "donor_secondary_project_id",
            "donor_id", "donor_name", "donor_iso3",
            "recipient_id", "recipient_name", "recipient_iso3",
            "start_date", "end_date", "commitment_date", "effective_date", "year",
            "commitment_current_usd", *texts,
            "crs_purpose_code", F.col("purpose_code").alias("classified_purpose_code"), "activity_codes",
        )
    )
