"""URL filters: host and path rules, then a blocked Bloom filter of listed URLs before an exact join.

A rule (host, path) fits its host and all subdomains if the URL's path starts with the rule's; the
longest rule decides. A URL without a rule is blocked if its canonical form is listed. The listed
forms set bits in blocks of 8 words of 32 bits: one hash chooses the block, another one bit in each
word. The filter is a table of blocks with a bounded number of rows, so it is broadcast; most URLs
fail it and are done. The few that pass go through a hash join with the list itself, which takes
the false positives out. A filter that is too small for its list only passes more URLs on.

Everything is a DataFrame expression: no Python runs in the tasks.

Defined results: a null URL, or one without "://", has an empty host and path, no rule and no
canonical form, and is allowed; so is any URL while the list is empty. Null entries of the list
count for nothing, repeated ones once. Repeated pages are judged one by one. A rule with an empty
host fits no URL. Of two fitting rules of one length the one with the longer host wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm.frames import free_name, staged

Rule = tuple[str, str, str]

RULES: tuple[Rule, ...] = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Names a host carries when it is listed for what it offers.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")

BITS_PER_URL = 16
_BLOCK_BITS = 256
_LANES = 8
# The broadcast filter has at most this many rows of nine longs (19 MB).
MOST_BLOCKS = 1 << 18

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Parameters that say where a visitor came from, not what is shown.
_TRACKING = "^(utm_[^=]*|ref|gclid|fbclid|sid|sessionid)(=|$)"


def _rest(url: Column) -> Column:
    """What follows the first "://"; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """One spelling for a URL: no scheme, user, default port, ``www.``, fragment, closing slash or tracking
    parameters, the host in lower case, the other parameters sorted. Null where there is no "://"."""
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(url_host(url), "^.*@", ""), ":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(url_path(url), "/+$", "")
    given = F.split(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(given, lambda p: (p != "") & ~p.rlike(_TRACKING))), "&")
    whole = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))
    return F.when(F.instr(url, "://") > 0, whole)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does. ``rules`` is a short policy."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        if rule_host:
            fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
            found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def listed_by_name(pages: DataFrame, words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """The list a crawl gives of itself: canonical URLs of pages whose host has a listed word among its names."""
    named = url_host(F.col("url")).rlike(rf"(^|[.-])({'|'.join(words)})([.-]|$)")
    return pages.where(named).select(canonical_url(F.col("url")).alias("listed"))


def _block(key: str, blocks: int) -> Column:
    return F.xxhash64(F.col(key)).bitwiseAND(F.lit(blocks - 1).cast("bigint"))


def _bits(key: str) -> list[Column]:
    """The bit that a URL sets in each word of its block."""
    return [F.expr(f"shiftleft(1L, cast(shiftright(xxhash64(`{key}`, 1), {5 * i}) & 31L as int))") for i in range(_LANES)]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of a one-column table ``listed``: at most ``blocks`` rows of a number and eight words."""
    words = [F.bit_or(bit).alias(f"word{i}") for i, bit in enumerate(_bits("listed"))]
    return listed.where("listed is not null").groupBy(_block("listed", blocks).alias("block")).agg(*words)


def blocks_for(n_listed: int) -> int:
    """A power of two of blocks with ``BITS_PER_URL`` bits for each URL, up to the bound of the broadcast."""
    blocks = 1 << 8
    while blocks < MOST_BLOCKS and blocks * _BLOCK_BITS < n_listed * BITS_PER_URL:
        blocks *= 2
    return blocks


def passes_filter(df: DataFrame, key: str, flag: str, listed: DataFrame, blocks: int) -> DataFrame:
    """``df`` with a column that is false where the key is certainly not listed."""
    bloom = free_name(df, "__bloom")
    words = bloom_blocks(listed, blocks).select(F.struct("*").alias(bloom))
    joined = df.join(F.broadcast(words), _block(key, blocks) == F.col(f"{bloom}.block"), "left")
    held = F.col(key).isNotNull()
    for i, bit in enumerate(_bits(key)):
        held &= F.col(f"{bloom}.word{i}").bitwiseAND(bit) == bit
    return joined.withColumn(flag, F.coalesce(held, F.lit(False))).drop(bloom)


def judge_urls(spark: SparkSession, pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``pages`` with host, path, rule and verdict; a name that ``pages`` has already gets an underscore.

    ``listed`` is a table with one column of canonical URLs.
    """
    # The list is used twice: for the filter and for the exact join.
    listed = staged(spark, listed.toDF("listed").where("listed is not null").distinct(), "listed-urls")
    host, path, rule, verdict, key, flag, fit, found = (
        free_name(pages, c) for c in ("host", "path", "rule", "verdict", "__canonical", "__possible", "__fit", "__listed")
    )
    judged = (
        pages.withColumn(host, F.coalesce(url_host(F.col("url")), F.lit("")))
        .withColumn(path, F.coalesce(url_path(F.col("url")), F.lit("")))
        .withColumn(fit, fitting_rule(F.col(host), F.col(path), rules))
        .withColumn(key, F.when(F.col(fit).isNull(), canonical_url(F.col("url"))))
    )
    screened = passes_filter(judged, key, flag, listed, blocks_for(listed.count()))
    # Only URLs that pass the filter are shuffled; a URL that many pages share is split by the join.
    exact = listed.select(F.col("listed").alias(found)).hint("shuffle_hash")
    possible = screened.where(F.col(flag)).join(exact, F.col(key) == F.col(found), "left")
    hits = possible.withColumn(flag, F.col(found).isNotNull()).drop(found)
    both = hits.unionByName(screened.where(~F.col(flag)))
    ruled = F.coalesce(F.col(f"{fit}.verdict"), F.when(F.col(flag), "block").otherwise("allow"))
    return both.withColumn(rule, F.col(f"{fit}.rule")).withColumn(verdict, ruled).drop(key, flag, fit)


def allowed_pages(spark: SparkSession, pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The pages, with their own columns, that are not blocked."""
    verdict = free_name(pages, "verdict")
    return judge_urls(spark, pages, listed, rules).where(F.col(verdict) == "allow").select(*(F.col(f"`{c}`") for c in pages.columns))


# The same without a filter: membership in the list itself.
URL_SQL = f"""
with rests as (
  select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from {{table}}),
parts as (
  select page_id, instr(url, '://') > 0 as whole, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'),
           lambda p: p <> '' and not regexp_matches(p, '{_TRACKING}'))), '&') as kept
  from rests),
keyed as (
  select *, case when whole then regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':(80|443)?$', ''), '^www\\.', '')
              || regexp_replace(path, '/+$', '') || case when kept <> '' then '?' || kept else '' end end as canonical
  from parts),
listed as (
  select distinct canonical from keyed where canonical is not null and regexp_matches(host, '(^|[.-])({"|".join(LISTED_WORDS)})([.-]|$)')),
rules(rule_host, rule_path, rule_verdict) as (values {", ".join(str(r) for r in RULES)}),
fits as (
  select page_id, host, path, rule_host || rule_path as rule, rule_verdict, canonical,
         row_number() over (partition by number order by length(rule_host || rule_path) desc nulls last, length(rule_host) desc) as place
  from (select *, row_number() over () as number from keyed) k
  left join rules r on (k.host = r.rule_host or ends_with(k.host, '.' || r.rule_host)) and starts_with(k.path, r.rule_path))
select page_id, host, path, rule,
       coalesce(rule_verdict, case when canonical in (select canonical from listed) then 'block' else 'allow' end) as verdict
from fits where place = 1
"""
