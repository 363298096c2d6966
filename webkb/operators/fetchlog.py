"""Crawl rules applied to tables: robots exclusion, retry folding, response
freshness (as-of join) and the per-domain request cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webkb.conf import CACHE_EXPIRATION_SECS, CACHE_IGNORE_HTTP_CODES, RETRY_HTTP_CODES, RETRY_TIMES
from webkb.functions.urls import host, path_and_query


def is_retryable(status) -> Column:
    s = F.col(status) if isinstance(status, str) else status
    return s.isin(*RETRY_HTTP_CODES)


def is_cacheable(status) -> Column:
    s = F.col(status) if isinstance(status, str) else status
    return ~s.isin(*CACHE_IGNORE_HTTP_CODES)


# ---------------------------------------------------------------------------
# robots
# ---------------------------------------------------------------------------
def _rule_regex(path: Column) -> Column:
    """Robots pattern -> anchored regex ('*' any run, trailing '$' = end)."""
    body = F.regexp_replace(path, r"\$$", "")
    esc = F.regexp_replace(body, r"([\\.+?^()\[\]{}|])", r"\\$1")
    rx = F.concat(F.lit("^"), F.regexp_replace(esc, r"\*", ".*"))
    return F.when(path.endswith("$"), F.concat(rx, F.lit("$"))).otherwise(rx)


def robots_rules(rules: DataFrame, agent: str = "*") -> DataFrame:
    """Rules of the groups that apply to ``agent`` (its own group when the host
    has one, else ``*``): ``host, path, allow, head, is_pattern, regex``.
    ``head`` is what stands before the first ``*`` or the closing ``$``: a URL
    that matches starts with it, and one that starts with it matches unless
    the rule is a pattern."""
    r = rules.select(
        F.lower("host").alias("host"), F.lower("agent").alias("agent"), F.lower("directive").alias("directive"),
        "path",
    ).filter(F.col("agent").isin(agent.lower(), "*") & (F.col("path") != ""))
    own = r.filter(F.col("agent") == agent.lower()).select("host").distinct().withColumn("_own", F.lit(True))
    r = r.join(own, "host", "left").filter(
        (F.col("agent") == agent.lower()) | F.col("_own").isNull() | F.lit(agent == "*")
    )
    path = F.col("path")
    return r.select("host", "path", (F.col("directive") == "allow").alias("allow")).distinct().select(
        "*", F.regexp_replace(F.substring_index(path, "*", 1), r"\$$", "").alias("head"),
        (path.contains("*") | path.endswith("$")).alias("is_pattern"), _rule_regex(path).alias("regex"))


def robots_filter(urls: DataFrame, rules: DataFrame, agent: str = "*", url_col: str = "url") -> DataFrame:
    """Adds ``allowed`` and ``rule``: the longest matching rule wins, allow
    wins a tie, no rule means allowed.

    A longest-prefix match by equality: a URL joins the rules of its host on
    its own prefixes, of the lengths that the heads of that host's rules have
    (no more of them than a path has characters, whatever the number of
    rules). The rules of a host are never in one row or one task. Only the
    distinct URLs take part; the other columns meet the verdicts of those
    that a rule matched."""
    r = robots_rules(rules, agent)
    lengths = r.groupBy("host").agg(F.collect_set(F.length("head")).alias("lengths"))
    u = urls.select(F.col(url_col).alias("_url")).distinct().select(
        "_url", host("_url").alias("host"), path_and_query("_url").alias("_pq"))
    prefixes = u.join(lengths, "host").select(
        "_url", "_pq", "host", F.explode(F.filter("lengths", lambda n: n <= F.length("_pq"))).alias("_n")).withColumn(
        "head", F.substring(F.col("_pq"), F.lit(1), F.col("_n")))
    hits = prefixes.join(r, ["host", "head"]).filter(~F.col("is_pattern") | F.regexp_like("_pq", F.col("regex")))
    best = hits.groupBy("_url").agg(F.max(F.struct(F.length("path").alias("n"), "allow", "path")).alias("_best"))
    return urls.join(best, F.col(url_col) == F.col("_url"), "left").select(
        *[urls[c] for c in urls.columns],
        F.coalesce(F.col("_best.allow"), F.lit(True)).alias("allowed"),
        F.col("_best.path").alias("rule"),
    )


# ---------------------------------------------------------------------------
# retries
# ---------------------------------------------------------------------------
def fold_retries(log: DataFrame, group: list[Column] | None = None, times: int = RETRY_TIMES) -> DataFrame:
    """One outcome per request group: up to ``1 + times`` attempts in
    ``(ts, attempt_id)`` order; the first non-retryable status ends the
    group, else the last of those attempts stands.

    The ``row_number() <= n`` filter becomes a group limit that runs
    before the shuffle too, so a hot URL ships at most n rows per task."""
    g = group if group is not None else [F.col("url"), F.to_date("ts").alias("day")]
    keyed = log.select(*g, "attempt_id", "ts", "status")
    names = [c for c in keyed.columns if c not in ("attempt_id", "ts", "status")]
    w = Window.partitionBy(*names).orderBy("ts", "attempt_id")
    n = keyed.withColumn("attempt", F.row_number().over(w)).filter(F.col("attempt") <= 1 + times)
    first_final = F.min(F.when(~is_retryable("status"), F.struct("attempt", "status", "attempt_id")))
    last = F.max(F.struct("attempt", "status", "attempt_id"))
    agg = n.groupBy(*names).agg(first_final.alias("ff"), last.alias("la"), F.count(F.lit(1)).alias("n_seen"))
    fin = F.coalesce(F.col("ff"), F.col("la"))
    return agg.select(
        *names,
        fin["status"].alias("final_status"),
        fin["attempt"].alias("attempts"),
        fin["attempt_id"].alias("final_attempt_id"),
        F.col("ff").isNull().alias("exhausted"),
    )


def final_responses(responses: DataFrame, log: DataFrame) -> DataFrame:
    """Responses ``(attempt_id, url, ...)`` of the attempts that end their
    URL's retries: one per URL, what :func:`fold_retries` lets stand."""
    final = fold_retries(log, [F.col("url")]).select(F.col("final_attempt_id").alias("attempt_id"))
    return responses.join(final, "attempt_id", "left_semi")


def _micros(c, df: DataFrame) -> Column:
    """Microseconds since the epoch of a TIMESTAMP, or of a TIMESTAMP_NTZ read
    as UTC, whatever the session's time zone."""
    if df.schema[c].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{c}`)")
    return F.unix_micros(c)


# ---------------------------------------------------------------------------
# response cache: as-of join
# ---------------------------------------------------------------------------
def cache_lookup(requests: DataFrame, cache: DataFrame, ttl_secs: int = CACHE_EXPIRATION_SECS,
                 bucket_secs: int | None = 3600) -> DataFrame:
    """For each request ``(attempt_id, url, ts)`` the latest cached response
    ``(attempt_id, url, ts)`` of the same URL with ``cache.ts <= req.ts``,
    its age in microseconds and ``fresh = age <= ttl``.

    Rows are partitioned by ``(url, time bucket)`` (an hour by default) so
    one busy URL spreads over many tasks; the latest entry of earlier
    buckets is carried over by a window over a one-row-per-(url, bucket)
    summary, so the result does not depend on the bucket width."""
    b_us = int((bucket_secs or ttl_secs) * 1_000_000)
    ts_type = cache.schema["ts"].dataType.simpleString()
    ent_type = f"struct<ts:{ts_type},attempt_id:bigint>"
    bucket = lambda df: F.floor(_micros("ts", df) / F.lit(b_us)).cast("long")
    ent = F.struct(F.col("ts").alias("ts"), F.col("attempt_id").cast("bigint").alias("attempt_id"))
    k = cache.select("url", "ts", "attempt_id").withColumn("bucket", bucket(cache))
    q = requests.select("url", "ts", "attempt_id").withColumn("bucket", bucket(requests))
    both = k.select("url", "bucket", "ts", F.lit(0).alias("kind"), "attempt_id", ent.alias("entry")).unionByName(
        q.select("url", "bucket", "ts", F.lit(1).alias("kind"), "attempt_id",
                 F.lit(None).cast(ent_type).alias("entry"))
    )
    w_in = Window.partitionBy("url", "bucket").orderBy("ts", "kind", "attempt_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    in_bucket = both.withColumn("hit", F.last("entry", ignorenulls=True).over(w_in)).filter(F.col("kind") == 1)
    summary = (
        k.groupBy("url", "bucket").agg(F.max(ent).alias("last_entry"))
        .unionByName(q.select("url", "bucket").distinct().withColumn(
            "last_entry", F.lit(None).cast(ent_type)))
        .groupBy("url", "bucket").agg(F.max("last_entry").alias("last_entry"))
    )
    w_carry = Window.partitionBy("url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.withColumn("carry", F.last("last_entry", ignorenulls=True).over(w_carry)).select(
        "url", "bucket", "carry")
    j = in_bucket.join(carry, ["url", "bucket"], "left")
    m = F.coalesce(F.col("hit"), F.col("carry"))
    j = j.select("attempt_id", "url", "ts", m["attempt_id"].alias("cached_attempt_id"), m["ts"].alias("cached_ts"))
    age = _micros("ts", j) - _micros("cached_ts", j)
    return j.select(
        "attempt_id", "url", "ts",
        "cached_attempt_id",
        "cached_ts",
        age.alias("age_us"),
        F.coalesce(age <= F.lit(int(ttl_secs * 1_000_000)), F.lit(False)).alias("fresh"),
    )


# ---------------------------------------------------------------------------
# per-domain cap
# ---------------------------------------------------------------------------
def domain_cap(urls: DataFrame, n: int, url_col: str = "url", order: list[Column] | None = None) -> DataFrame:
    """At most ``n`` requests per host, in ``(depth, url)`` order. The rank
    filter becomes a group limit applied before the shuffle as well."""
    o = order if order is not None else ([F.col("depth")] if "depth" in urls.columns else []) + [F.col(url_col)]
    u = urls.withColumn("host", host(url_col))
    w = Window.partitionBy("host").orderBy(*o)
    return u.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
