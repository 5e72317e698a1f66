"""URL filter: rules on host and path, and a list of canonical addresses behind a Bloom filter."""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyport.llm.bloom import MAX_BLOCKS, BlockedBloom
from tallyport.llm.registry import query
from tallyport.llm.tables import table

PLACE = "://([^/?#]*)([^?#]*)"
# Parameters that only say where a visitor came from.
TRACKING = "(^|&)(utm_[^=&]*|ref)=[^&]*"


@dataclass(frozen=True)
class Rule:
    """Fits `host` and its subdomains where the path starts with `path`; `text` is both joined."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_of(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, PLACE, 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PLACE, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without `www.`, path without last slashes, query without tracking; no scheme, no fragment."""
    asked = F.coalesce(F.regexp_extract(url, r"^[^#]*?\?([^#]*)", 1), F.lit(""))
    kept = F.regexp_replace(F.regexp_replace(asked, TRACKING, ""), "^&", "")
    place = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/+$", ""))
    return F.when(kept == "", place).otherwise(F.concat(place, F.lit("?"), kept))


def judged(
    pages: DataFrame,
    rules: list[Rule],
    listed: DataFrame,
    url_col: str = "url",
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """Adds host, path, canonical, listed, rule and verdict to the rows of `pages`.

    `rules` is a short list (it becomes one expression); the longest fitting rule decides,
    between equally long ones that with the longer host. Otherwise an address is blocked if
    its canonical form is in `listed` (one column of canonical addresses, of any size). A
    Bloom filter of bounded size over `listed` lets possible hits through, and only these
    meet the list itself in a join, which settles the verdict exactly. A null url or one
    without `://` has an empty host and path, and fits no rule. Columns of `pages` that have
    the names of added ones are replaced; a list entry that is null matches nothing.
    """
    url = F.col(url_col).cast("string")
    placed = pages.withColumn("__url", url).withColumns(
        {"host": host_of(F.col("__url")), "path": path_of(F.col("__url")), "canonical": canonical(F.col("__url"))}
    )
    ranked = sorted(rules, key=lambda r: (-len(r.text), -len(r.host)))
    fits = [
        ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col("path").startswith(r.path) for r in ranked
    ]
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, fit in reversed(list(zip(ranked, fits, strict=True))):
        rule, said = F.when(fit, r.text).otherwise(rule), F.when(fit, r.verdict).otherwise(said)
    placed = placed.withColumns({"rule": rule, "__said": said}).drop("__url")

    entries = listed.select(F.col(listed.columns[0]).cast("string").alias("__entry")).where("__entry is not null").distinct()
    marked = BlockedBloom(entries, F.col("__entry"), max_blocks).marked(placed, F.col("canonical"), "__likely")
    sure = marked.where("__likely").join(entries, F.col("canonical") == F.col("__entry"), "left")
    sure = sure.withColumn("listed", F.col("__entry").isNotNull()).drop("__entry")
    rest = marked.where(~F.col("__likely")).withColumn("listed", F.lit(False))
    verdict = F.coalesce("__said", F.when(F.col("listed"), "block").otherwise("allow"))
    return sure.unionByName(rest).withColumn("verdict", verdict).drop("__said", "__likely")


RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]
# Hosts with one of these labels are taken as the source of the list of addresses.
LABELS = ["cheap-pills", "casino-win", "spam-farm", "free-bets"]


@query(
    "op1_url_filter",
    r"""
    with placed as (
        select page_id,
            translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path,
            regexp_replace(regexp_replace(coalesce(regexp_extract(url, '^[^#]*?\?([^#]*)', 1), ''),
                '(^|&)(utm_[^=&]*|ref)=[^&]*', '', 'g'), '^&', '') as kept
        from pages
    ), named as (
        select page_id, host, path,
            regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') || case when kept = '' then '' else '?' || kept end as canonical
        from placed
    ), listed as (
        select distinct canonical from named where regexp_matches(host, '(^|\.)(cheap-pills|casino-win|spam-farm|free-bets)\.')
    )
    select page_id, host, path, canonical,
        case when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
             when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
             when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
             when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule,
        case rule when 'example.net/en/' then 'allow' when 'org/fr/' then 'allow' when 'net/' then 'block' when 'example.com/de/' then 'block'
             else case when canonical in (select canonical from listed) then 'block' else 'allow' end end as verdict
    from named
    """,
)
def op1_url_filter(spark, sf_dir):
    """Every page's address judged; the list holds the canonical addresses found on hosts of bad name."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    label = reduce(Column.__or__, [F.concat(F.lit("."), host_of(F.col("url"))).contains(f".{x}.") for x in LABELS])
    listed = pages.where(label).select(canonical(F.col("url")).alias("entry"))
    return judged(pages, RULES, listed).select("page_id", "host", "path", "canonical", "rule", "verdict")
