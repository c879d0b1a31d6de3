"""File discovery from index pages and incremental loading, as table operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.columns import base_name, safe_filename
from tabprep.sizing import local_table

# The href of an anchor tag, in either kind of quotes.
HREF_PATTERN = r"""<[aA]\s(?:[^>]*?\s)?[hH][rR][eE][fF]\s*=\s*["']([^"']*)["']"""


def page_links(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """Every anchor target of every page, one row per link, with the kept page columns."""
    return pages.select(*keep, F.explode(F.regexp_extract_all(F.col(html_col), F.lit(HREF_PATTERN), F.lit(1))).alias("href"))


def link_filter(href: Column, suffix: str, code: Column, match: str = "contains") -> Column:
    """Case-folded test on a link: right suffix, and the module code in the URL or at the start of its file name."""
    folded = F.lower(href)
    ends = folded.endswith(suffix.lower())
    if match == "contains":
        return ends & folded.contains(F.lower(code))
    if match == "prefix":
        return ends & F.lower(base_name(href)).startswith(F.lower(code))
    raise ValueError("match must be 'contains' or 'prefix'")


def work_list(spark: SparkSession, cycles: Sequence[str], modules: Sequence[str]) -> DataFrame:
    """Every cycle with every module code, in order."""
    rows = [(c, m, i) for i, (c, m) in enumerate((c, m) for c in cycles for m in modules)]
    return local_table(spark, rows, "cycle string, module string, seq int")


def work_list_of(cycles: DataFrame, cycle_col: str, modules: Sequence[str]) -> DataFrame:
    """S9 from a table: every distinct cycle in it with every module code."""
    found = cycles.select(F.col(cycle_col).cast("string").alias("cycle")).where("cycle is not null").distinct()
    return found.select("cycle", F.explode(F.array(*[F.lit(m) for m in modules])).alias("module"))


def harvest_links(
    pages: DataFrame,
    codes: Sequence[str],
    base_url: str = "",
    suffix: str = ".xpt",
    html_col: str = "html",
    keep: Sequence[str] = (),
    match: str = "contains",
) -> DataFrame:
    """Links to files of the wanted modules: kept page columns, `code`, `href`, `link`, `file`.

    The short list of codes travels as an array literal, so there is no join and no shuffle.
    """
    links = page_links(pages, html_col, keep)
    wanted = F.filter(
        F.array(*[F.lit(c) for c in codes]), lambda code: link_filter(F.col("href"), suffix, code, match)
    )
    return links.select(*keep, "href", F.explode(wanted).alias("code")).select(
        *keep, "code", "href",
        F.concat(F.lit(base_url), F.col("href")).alias("link"),
        safe_filename(base_name(F.col("href"))).alias("file"),
    )


def not_yet_loaded(candidates: DataFrame, manifest: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Candidates the manifest does not list."""
    return candidates.join(manifest.select(*keys), list(keys), "left_anti")


def append_manifest(loaded: DataFrame, path: str, keys: Sequence[str] = ("file",)) -> None:
    """Write back the keys of a finished load, so the next run skips them."""
    loaded.select(*keys).distinct().write.mode("append").parquet(path)


def load_outcomes(candidates: DataFrame, manifest: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Candidates with `status` 'skipped' when already listed, else 'new'. The manifest has one row per key."""
    known = manifest.select(*keys, F.lit(True).alias("known"))
    return candidates.join(known, list(keys), "left").withColumn(
        "status", F.when(F.col("known"), "skipped").otherwise("new")
    ).drop("known")
