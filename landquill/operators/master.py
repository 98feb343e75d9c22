"""Companies: names, market values, filings, rejects, incremental work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landquill.shared import checkpointed


def distinct_codes(rows: DataFrame, code: str = "code", seq: str = "seq") -> DataFrame:
    """Trimmed, non-empty codes with the place of their first row."""
    return rows.select(F.trim(code).alias("code"), seq).filter("code <> ''").groupBy("code").agg(F.min(seq).alias("seq"))


def is_placeholder(name: Column, code: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(name, F.lit("")), r"[\s　]+", "")
    return (bare == "") | (bare == code)


def resolve_names(targets: DataFrame, *masters: DataFrame) -> DataFrame:
    """company_name by priority: the target's own, then that of each master; empty and placeholder names don't count."""
    out = targets
    choices = [F.when(~is_placeholder(F.col("company_name"), F.col("code")), F.trim("company_name"))]
    for k, master in enumerate(masters):
        out = out.join(master.select("code", F.col("company_name").alias(f"_m{k}")), "code", "left")
        choices.append(F.when(~is_placeholder(F.col(f"_m{k}"), F.col("code")), F.trim(f"_m{k}")))
    return out.withColumn("company_name", F.coalesce(*choices)).drop(*[f"_m{k}" for k in range(len(masters))])


def latest_price(prices: DataFrame, asof: Column, max_age_days: int = 7) -> DataFrame:
    """code, date, close: the last price at or before ``asof``, unless it is older than the given days."""
    known = prices.filter(F.col("date") <= asof)
    last = known.groupBy("code").agg(F.max("date").alias("date"), F.max_by("close", F.struct("date", "close")).alias("close"))
    return last.filter(F.col("date") >= asof - F.make_dt_interval(F.lit(max_age_days)))


def market_caps(targets: DataFrame, stock: DataFrame, asof: Column, max_age_days: int = 7) -> DataFrame:
    """market_cap: the target's own, else shares times the last price; null if neither is known."""
    last = latest_price(stock, asof, max_age_days).select("code", F.col("close").alias("_close"))
    out = targets.join(last, "code", "left")
    return out.withColumn("market_cap", F.coalesce("market_cap", (F.col("shares") * F.col("_close")).cast("long"))).drop("_close")


def latest_per(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by the given columns."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order)).alias("_r")).select(key, "_r.*")


def split_rejects(rows: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects with the first rule that a row meets as ``reject_reason``)."""
    reason = None
    for name, rule in rules:
        rule = F.coalesce(rule, F.lit(False))
        reason = F.when(rule, name) if reason is None else reason.when(rule, name)
    marked = rows.withColumn("reject_reason", reason)
    return marked.filter("reject_reason IS NULL").drop("reject_reason"), marked.filter("reject_reason IS NOT NULL")


def upsert_names(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """code, company_name, updated_at: new names win unless empty; rows that come anew are marked with ``now``."""
    o = old.select("code", F.col("company_name").alias("_o"), F.col("updated_at").alias("_t"))
    n = new.select("code", F.nullif(F.trim("company_name"), F.lit("")).alias("_n"), F.lit(True).alias("_new"))
    return o.join(n, "code", "full").select("code", F.coalesce("_n", "_o", F.lit("")).alias("company_name"), F.when(F.col("_new"), now).otherwise(F.col("_t")).alias("updated_at"))


def save_bucketed(rows: DataFrame, table: str, path: str, buckets: int = 64, key: str = "code") -> DataFrame:
    """``rows`` as a table whose files are dealt out and sorted by ``key``; tables of as many buckets are joined by it without a shuffle.

    The rows are dealt out once, when they are written; every later run reads its buckets as they lie. ``table`` is replaced if it is there.
    """
    rows.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return rows.sparkSession.table(table)


def signature(*fields: str) -> Column:
    """md5 of the fields as JSON, in the order of their names; nulls are left out of it by name."""
    return F.md5(F.to_json(F.struct(*sorted(fields))))


def changed_keys(old: DataFrame, new: DataFrame, key: str = "code", mark: str = "signature") -> DataFrame:
    """key, change: added, changed or deleted."""
    o, n = old.select(key, F.col(mark).alias("_o"), F.lit(1).alias("_io")), new.select(key, F.col(mark).alias("_n"), F.lit(1).alias("_in"))
    both = o.join(n, key, "full")
    change = F.when(F.col("_io").isNull(), "added").when(F.col("_in").isNull(), "deleted").when(~F.col("_o").eqNullSafe(F.col("_n")), "changed")
    return both.select(key, change.alias("change")).filter("change IS NOT NULL")


def bucket_digests(rows: DataFrame, key: str = "code", mark: str = "signature", buckets: int = 1 << 16, bucket: Column | None = None) -> DataFrame:
    """bucket, n, total, mixed: what stays the same for each bucket of keys as long as no key and mark in it change.

    The digest is the number of rows, the sum and the exclusive or of their hashes, so the order of rows doesn't matter
    and tasks add up their own rows before the shuffle: it moves ``buckets`` rows of a task at most. Digests are small and may be kept beside the rows.
    """
    at = F.pmod(F.xxhash64(key), F.lit(buckets)) if bucket is None else bucket
    h = F.xxhash64(key, mark, F.col(mark).isNull())
    return rows.groupBy(at.cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("total"), F.bit_xor(F.xxhash64(F.lit(7), key, mark, F.col(mark).isNull())).alias("mixed"))


def differing_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """bucket: those of two sets of digests that aren't the same."""
    o, n = old.select("bucket", F.struct("n", "total", "mixed").alias("_o")), new.select("bucket", F.struct("n", "total", "mixed").alias("_n"))
    return o.join(n, "bucket", "full").filter(~F.col("_o").eqNullSafe(F.col("_n"))).select("bucket")


def changed_keys_by_digest(old: DataFrame, new: DataFrame, key: str = "code", mark: str = "signature", buckets: int = 1 << 16, bucket: Column | None = None) -> DataFrame:
    """As ``changed_keys``, for tables of which little changes: only rows of buckets whose digests differ are shuffled and joined.

    ``bucket``, a function of the key, takes the place of its hash if given, with at most ``buckets`` values. A key is to be in a table once.
    """
    at = F.pmod(F.xxhash64(key), F.lit(buckets)) if bucket is None else bucket
    differ = F.broadcast(checkpointed(differing_buckets(bucket_digests(old, key, mark, buckets, bucket), bucket_digests(new, key, mark, buckets, bucket))))
    some = [side.select(key, mark).join(differ, at.cast("long").eqNullSafe(differ["bucket"]), "left_semi") for side in (old, new)]
    return changed_keys(some[0], some[1], key, mark)


def to_process(targets: DataFrame, signatures: DataFrame, outputs: DataFrame) -> DataFrame:
    """Targets whose signature differs from the stored one or which have no valid output."""
    same = signatures.select("code", F.col("signature").alias("_s"))
    valid = outputs.filter("valid").select("code").distinct()
    done = targets.join(same, "code").filter(F.col("signature").eqNullSafe(F.col("_s"))).join(valid, "code", "left_semi").select("code")
    return targets.join(done, "code", "left_anti")


def reuse_extractions(filings: DataFrame, stored: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(filings whose fingerprint no stored row has, stored rows that stay valid)."""
    rule = lambda a, b: _all_equal(a, b, on)
    fresh = filings.join(stored.select(*[F.col(c).alias(f"_{c}") for c in on]), rule("", "_"), "left_anti")
    kept = stored.join(filings.select(*[F.col(c).alias(f"_{c}") for c in on]), rule("", "_"), "left_semi")
    return fresh, kept


def _all_equal(a: str, b: str, on: list[str]) -> Column:
    out = F.lit(True)
    for c in on:
        out = out & (F.col(a + c) == F.col(b + c))
    return out


def merge_patches(overrides: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged overrides, effect of every patch: added, updated, unchanged or error).

    overrides and patches: code, site_name, address. Patches without an
    address are errors and change nothing.
    """
    text = F.trim(F.coalesce("address", F.lit("")))
    good = patches.filter(text != "").select("code", "site_name", text.alias("_p"))
    bad = patches.filter(text == "").select("code", "site_name", F.lit("error").alias("effect"))
    old = overrides.select("code", "site_name", "address")
    both = old.join(good, ["code", "site_name"], "full")
    merged = both.select("code", "site_name", F.coalesce("_p", "address").alias("address"))
    effect = F.when(F.col("address").isNull(), "added").when(F.col("address") == F.col("_p"), "unchanged").otherwise("updated")
    return merged, both.filter("_p IS NOT NULL").select("code", "site_name", effect.alias("effect")).unionByName(bad)


def run_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status", F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def without_memo(companies: DataFrame, memos: DataFrame) -> DataFrame:
    return companies.join(memos.select("code").distinct(), "code", "left_anti")


def low_resolution(rows: DataFrame, n: int) -> DataFrame:
    """The first n companies by rank with a tag of a coarse geocode."""
    return rows.filter(F.rlike("tags", F.lit("muni_centroid|oaza_chome"))).orderBy("rank").limit(n)


def risk_summary(sites: DataFrame) -> DataFrame:
    """sites: code, seq, site_name, level, risk; code, all_gaiku, has_risk, flags (by seq)."""
    flag = F.struct("seq", "site_name", "risk")
    return sites.groupBy("code").agg(F.bool_and(F.coalesce(F.col("level") == "gaiku", F.lit(False))).alias("all_gaiku"), F.bool_or("risk").alias("has_risk"), F.array_sort(F.collect_list(flag)).alias("flags"))


def first_by(rows: DataFrame, partition: list[str], *order: Column) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).filter("_n = 1").drop("_n")
