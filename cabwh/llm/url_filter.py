"""URL filter: explicit rules first, then the host's reputation by empirical Bayes.

1. A url's host is what follows the first ``://`` up to ``/``, ``?`` or ``#``, its path goes on up to ``?`` or ``#``.
   The longest rule whose host is the url's or a parent of it, and whose path starts the url's, decides.
2. Every other page is judged by its host. Labelled pages are outcomes (bad or not), counted by host. The share of
   bad pages has a beta prior at each level: a suffix's from all pages, a registered domain's from its suffix, a
   host's from its domain. A prior's mean is the posterior mean of the level above; its strength is estimated from
   the data, one per level, by the method of moments: the more the groups differ beyond chance, the weaker it is.
3. A host is blocked if the lower bound of its posterior share of bad pages is ``BLOCK_RATE`` or more. The bound is
   that of the logit-normal with the posterior's mean and variance of log odds (digamma and trigamma functions); it
   is at most 0.04 below the beta's own quantile, and not above it by more than 0.01.

All of it is DataFrame functions. Pages are reduced to counts by host before anything meets, and every lookup of a
host, domain or suffix is salted, so a host, or a domain with very many hosts, is spread over many tasks.

Defined cases: a null url and one without ``://`` have an empty host and path, which no rule fits and which count as a
host of their own; a registered domain is the suffix and one label more, a suffix the last label, or two of them below
a country's ``co``, ``com``, ``org``, ``net``, ``ac``, ``gov`` or ``edu``; an address of digits is its own
domain; without any outcomes the prior is one bad page in two for all, whose bound blocks nothing; rows that
repeat a page id are judged each; an item with several labels is bad if one of them says so; empty tables
give no rows; very long urls are taken whole; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import SALTS, first_per_key, lookup_salted, plain, salt_of, table, written

#: Quantile of the normal distribution for the bound (95 %).
Z = 1.6448536269514722
BLOCK_RATE = 0.5
#: A prior counts as at least so many pages, and at most so many.
WEAKEST, STRONGEST = 1.0, 1000.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COUNTRY = r"(?:co|com|org|net|ac|gov|edu)\.[a-z]{2}"
SUFFIX = rf"(?:(?:^|\.){_COUNTRY}|[^.]+)\z"
DOMAIN = rf"(?:[^.]+\.)?(?:{_COUNTRY}|[^.]+)\z"
ADDRESS = r"^[0-9.]+\z"
#: What a host name may have after its labels: a dot, a port.
TAIL = r"\.?(?::[0-9]*)?\z"


class Rule(NamedTuple):
    """``verdict`` for the host, its subdomains, and paths that start with ``path`` (``/`` for all)."""

    verdict: str
    host: str
    path: str = "/"


#: Fixed values of the query's contract.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _by_rules(rules: tuple[Rule, ...] | list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(text of the longest rule that fits, its verdict), null if none does; of equal ones, a block."""
    order = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict != "block"))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in order]
    pick = lambda value: F.coalesce(*[F.when(f, F.lit(value(r))) for f, r in zip(fits, order, strict=True)],
                                    F.lit(None).cast("string"))
    return pick(lambda r: r.host + r.path), pick(lambda r: r.verdict)


def suffix_of(host: Column) -> Column:
    return F.ltrim(F.regexp_extract(F.regexp_replace(host, TAIL, ""), SUFFIX, 0), F.lit("."))


def domain_of(host: Column) -> Column:
    """Suffix and one label more; an address of digits and a host without a dot are their own."""
    name = F.regexp_replace(host, TAIL, "")
    return F.when(name.rlike(ADDRESS), name).otherwise(F.regexp_extract(name, DOMAIN, 0))


# --- the posterior ------------------------------------------------------------------------------------------


def digamma(x: Column) -> Column:
    """Six steps of the recurrence, then the asymptotic series."""
    y = x + 6
    steps = sum((1 / (x + i) for i in range(1, 6)), 1 / x)
    return F.log(y) - 1 / (2 * y) - 1 / (12 * y * y) + 1 / (120 * y * y * y * y) - steps


def trigamma(x: Column) -> Column:
    y = x + 6
    steps = sum((1 / ((x + i) * (x + i)) for i in range(1, 6)), 1 / (x * x))
    return 1 / y + 1 / (2 * y * y) + 1 / (6 * y * y * y) - 1 / (30 * y * y * y * y * y) + steps


def lower_bound(bad: Column, good: Column, z: float = Z) -> Column:
    """Lower bound of a Beta(bad, good) share by its log odds."""
    centre, spread = digamma(bad) - digamma(good), F.sqrt(trigamma(bad) + trigamma(good))
    return 1 / (1 + F.exp(-(centre - z * spread)))


def _strength(groups: DataFrame) -> float:
    """The strength of a level's prior, from its groups (n, bad, prior): the method of moments for beta-binomials.

    With share p and correlation r of a group's pages, the variance of ``bad`` is n p (1 - p) (1 + (n - 1) r),
    and the strength is 1 / r - 1.
    """
    p, n = F.col("prior"), F.col("n").cast("double")
    gap = F.col("bad") - n * p
    more, room = groups.agg(F.sum(gap * gap - n * p * (1 - p)), F.sum(n * (n - 1) * p * (1 - p))).first()
    r = more / room if room else 0.0
    return min(STRONGEST, max(WEAKEST, 1 / r - 1)) if r > 0 else STRONGEST


def _posterior(groups: DataFrame, strength: float) -> DataFrame:
    """``groups`` (n, bad, prior) with the posterior's parameters ``a`` (bad) and ``b``."""
    return (groups.withColumn("a", F.lit(strength) * F.col("prior") + F.col("bad"))
            .withColumn("b", F.lit(strength) * (1 - F.col("prior")) + F.col("n") - F.col("bad")))


def _level(rows: DataFrame, key: str) -> DataFrame:
    """The groups of one level with their posterior; ``rows`` (key, salt, n, bad, prior) are those of the level below
    or, for hosts, the hosts themselves; a group's rows have one prior."""
    part = rows.groupBy(key, "salt").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"),
                                         F.first("prior").alias("prior"))
    groups = written(part.groupBy(key).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.first("prior").alias("prior"),
        F.collect_list("salt").alias("salts")), f"level-{key}")
    return _posterior(groups, _strength(groups))


def host_reputation(hosts: DataFrame, z: float = Z) -> DataFrame:
    """(host, n, bad, a, b, bound) for ``hosts`` (host, n, bad; hosts distinct): labelled pages and bad ones.

    Hosts without labelled pages have n = 0: their posterior is their domain's.
    """
    rows = written(hosts.select("host", F.col("n").cast("long"), F.col("bad").cast("long")).withColumns({
        "domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host")), "salt": salt_of("host")}), "hosts")
    n, bad = rows.agg(F.sum("n"), F.sum("bad")).first()
    # one page more, half of it bad: the overall share is never 0 or 1
    overall = ((bad or 0) + 0.5) / ((n or 0) + 1)
    at = rows.withColumn("prior", F.lit(overall))
    for key in ("suffix", "domain"):
        groups = _level(at, key).select(key, "salts", (F.col("a") / (F.col("a") + F.col("b"))).alias("prior"))
        at = lookup_salted(at.drop("prior"), groups, key).withColumn("salt", salt_of("host"))
    at = written(at, "host-priors")
    return _posterior(at, _strength(at)).select(
        "host", "n", "bad", "a", "b", lower_bound(F.col("a"), F.col("b"), z).alias("bound"))


# --- the filter ---------------------------------------------------------------------------------------------


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] | list[Rule] = RULES,
               item: Column | None = None, block_rate: float = BLOCK_RATE, z: float = Z, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, n and bad (labelled pages of its host), bound, verdict.

    ``outcomes`` (item, bad): labelled items. ``item`` tells a page's item from ``id`` and ``url``; without it, a
    page's id is its item.
    """
    rows = plain(pages, id=id_col, url=url_col)
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")),
                             "item": F.col("id") if item is None else item})
    rule, verdict = _by_rules(rules, F.col("host"), F.col("path"))
    rows = written(rows.withColumns({"rule": rule, "told": verdict}).drop("url").withColumn(
        "salt", F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)).cast("int")), "urls")
    # pages of an item by host; an item with very many hosts is spread by them
    shown = rows.filter("item is not null").groupBy("item", "host").agg(F.count(F.lit(1)).alias("pages"))
    shown = shown.withColumn("salt", salt_of("host"))
    told = outcomes.filter("bad is not null").groupBy("item").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    items = first_per_key(shown, "item", "host").drop("first_id", "n").join(told, "item")
    labelled = lookup_salted(shown, items, "item").select(
        "host", F.col("pages").alias("n"), (F.col("pages") * F.col("bad")).alias("bad"))
    every = rows.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    hosts = every.unionByName(labelled).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    known = host_reputation(hosts, z).select("host", "n", "bad", "bound")
    known = first_per_key(rows, "host", "id").drop("first_id", "n").join(known, "host")
    decided = lookup_salted(rows, known, "host")
    method = F.when(F.col("bound") >= block_rate, F.lit("block")).otherwise(F.lit("allow"))
    return decided.select("id", "host", "path", "rule", "n", "bad", "bound",
                          F.coalesce("told", method).alias("verdict"))


def keep_allowed(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """The pages that stay, with all their columns; rows that repeat an id stay if one of them does."""
    kept = judge_urls(pages, outcomes, id_col=id_col, **options).filter("verdict = 'allow'")
    kept = kept.select(F.col("id").alias("__kept_id")).distinct()
    return pages.join(kept, pages[id_col].eqNullSafe(kept["__kept_id"]), "left_semi")


#: A page shows the document whose number is the last digits-only part of its path; its label is the page's outcome.
ITEM = r"://[^?#]*/([0-9]{1,18})(?:\.html)?/?(?:[?#]|\z)"


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item"), (F.col("quality") == 0).alias("bad"))
    number = F.regexp_extract(F.coalesce("url", F.lit("")), ITEM, 1)
    return judge_urls(table(spark, sf_dir, "pages"), labels,
                      item=F.when(number != "", number.cast("long"))).select(
        F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def _digamma_sql(x: str) -> str:
    y, steps = f"({x} + 6)", " + ".join(f"1 / ({x} + {i})" for i in range(6))
    return f"(ln({y}) - 1 / (2 * {y}) - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - ({steps}))"


def _trigamma_sql(x: str) -> str:
    y, steps = f"({x} + 6)", " + ".join(f"1 / (({x} + {i}) ** 2)" for i in range(6))
    return f"(1 / {y} + 1 / (2 * {y} ** 2) + 1 / (6 * {y} ** 3) - 1 / (30 * {y} ** 5) + {steps})"


def _strength_sql(level: str) -> str:
    """One row: the strength of the prior of ``level`` (n, bad, prior)."""
    r = ("sum((bad - n * prior) ** 2 - n * prior * (1 - prior)) "
         "/ nullif(sum(n::DOUBLE * (n - 1) * prior * (1 - prior)), 0)")
    return (f"(SELECT CASE WHEN r > 0 THEN least({STRONGEST}::DOUBLE, greatest({WEAKEST}::DOUBLE, 1 / r - 1)) "
            f"ELSE {STRONGEST}::DOUBLE END AS m FROM (SELECT {r} AS r FROM {level}))")


def _level_sql(key: str, above: str) -> str:
    mean = f"(m * prior + bad) / (m + n) AS {key}_mean"
    return (f"{key}_groups AS (SELECT {key}, sum(n) AS n, sum(bad) AS bad, any_value({above}) AS prior "
            f"FROM {above}_known GROUP BY {key}),\n"
            f"{key}_mean_known AS (SELECT k.*, {key}_mean FROM {above}_known k JOIN "
            f"(SELECT {key}, {mean} FROM {key}_groups, {_strength_sql(key + '_groups')}) USING ({key}))")


def _rules_sql() -> str:
    rows = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
    return (f"rules AS (SELECT * FROM (VALUES {rows}) AS t(told, rule_host, rule_path)),\n"
            "ruled AS (SELECT u.n_row, first(rule_host || rule_path ORDER BY length(rule_host || rule_path) DESC) AS rule, "
            "first(told ORDER BY length(rule_host || rule_path) DESC) AS told FROM urls u JOIN rules "
            "ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY u.n_row)")


SQL = rf"""
WITH urls AS (
  SELECT row_number() OVER () AS n_row, page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
         TRY_CAST(regexp_extract(coalesce(url, ''), '{ITEM}', 1) AS BIGINT) AS item
  FROM pages),
{_rules_sql()},
told AS (SELECT doc_id AS item, max((quality = 0)::INT) AS bad FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
hosts AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
                 ltrim(regexp_extract(regexp_replace(host, '{TAIL}', ''), '{SUFFIX}', 0), '.') AS suffix,
                 CASE WHEN regexp_matches(regexp_replace(host, '{TAIL}', ''), '{ADDRESS}') THEN regexp_replace(host, '{TAIL}', '')
                      ELSE regexp_extract(regexp_replace(host, '{TAIL}', ''), '{DOMAIN}', 0) END AS domain
          FROM urls LEFT JOIN told USING (item) GROUP BY host),
overall_known AS (SELECT *, (sum(bad) OVER () + 0.5::DOUBLE) / (sum(n) OVER () + 1) AS overall FROM hosts),
{_level_sql("suffix", "overall")},
{_level_sql("domain", "suffix_mean")},
host_groups AS (SELECT host, n, bad, domain_mean AS prior FROM domain_mean_known),
posterior AS (SELECT host, m * prior + bad AS a, m * (1 - prior) + n - bad AS b
              FROM host_groups, {_strength_sql("host_groups")}),
bounds AS (SELECT host, 1 / (1 + exp(-({_digamma_sql("a")} - {_digamma_sql("b")}
                                       - {Z} * sqrt({_trigamma_sql("a")} + {_trigamma_sql("b")})))) AS bound FROM posterior)
SELECT page_id, host, path, rule, coalesce(told, CASE WHEN bound >= {BLOCK_RATE} THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN ruled USING (n_row) JOIN bounds USING (host)
"""
