"""Lines that repeat across the pages of one site, by site-relative frequency.

For each host and line, the pages that contain the line are divided by the pages of the host; lines
above ``MAX_SHARE`` are boilerplate of that host and leave its pages. All steps are column functions,
joins and aggregations.

A host has at most (its lines per page / ``MAX_SHARE``) such lines, which bounds the list that is
joined to its pages. Counts are added up before the shuffle, so a line on a third of all pages is
one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.tables import same
from leadloom.session import materialise

MAX_SHARE = 0.25
#: A line is judged once it stands on so many pages of its host.
MIN_PAGES = 3

#: Parts of a page without text, tags that end a line, and character references of common signs.
#: What never ends goes to the end of the page (a head to the body's tag): all ends are given there once, behind a mark, so that no
#: pattern is tried anew at each of its beginnings.
MARK = "\x01-->"
ENDS = MARK + "</script></style></noscript></template></head>"
HIDDEN = (
    r"(?is)<!--.*?-->", *(rf"(?is)<{t}\b.*?</{t}\s*>" for t in ("script", "style", "noscript", "template")),
    r"(?is)<head\b.*?(?:</head\s*>|<body\b[^>]*>)",
)
TAGS = r"<[A-Za-z/!?][^>]*>"
BREAKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|button|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]"
    r"|header|hr|html|label|legend|li|main|menu|nav|ol|option|p|pre|section|select|summary|table|tbody|td|tfoot|th|thead|tr|ul)\b[^>]*>"
)
SIGNS = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column | str) -> Column:
    """Host of a URL in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def html_lines(html: Column | str) -> Column:
    """Lines of text of a page, white space collapsed, blank lines left out; none for a null page."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    text = F.concat(text, F.lit(ENDS))
    for pattern in HIDDEN:
        text = F.regexp_replace(text, pattern, "\n")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAGS, "")
    text = F.replace(text, F.lit(MARK), F.lit(""))
    for name, sign in SIGNS:
        text = F.replace(text, F.lit(name), F.lit(sign))
    text = F.regexp_replace(text, " +", " ")
    return F.array_remove(F.transform(F.split(text, " *\n *"), lambda x: F.trim(x)), "")


def _key(line: Column) -> Column:
    """128 bits of a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(pages: DataFrame, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines) -> (host, line key, n_pages, host_pages) of the lines above the share."""
    counted = pages.select("host", F.explode(F.array_distinct(F.transform("lines", _key))).alias("key")).groupBy("host", "key").agg(F.count("*").alias("n_pages"))
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    often = counted.filter(F.col("n_pages") >= min_pages)
    return often.join(totals, "host").filter(F.col("n_pages") > F.col("host_pages") * max_share)


def drop_site_lines(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """``keep`` with n_lines, n_dropped and text (the lines left, joined by line ends) of every page.

    Null and empty pages have no lines; pages without a host form one site; a line that a page repeats
    counts once; repeated rows are pages of their own; pages of a site too small to judge keep all
    lines; an empty table gives no rows. The lines are cut once and stored. Columns other than ``keep``, url and html are not read.
    """
    cut = materialise(pages.select(*keep, host_of(url).alias("_host"), html_lines(html).alias("_lines")))
    found = boilerplate(cut.select(F.col("_host").alias("host"), F.col("_lines").alias("lines")), max_share, min_pages)
    by_host = materialise(found.groupBy(F.col("host").alias("_host")).agg(F.collect_list("key").alias("_often")))
    joined = cut.join(by_host, same(cut, by_host, ["_host"]), "left").select(cut["*"], "_often")
    left = F.when(F.col("_often").isNull(), F.col("_lines")).otherwise(F.filter("_lines", lambda x: ~F.array_contains("_often", _key(x))))
    done = joined.withColumn("_left", left)
    n, m = F.size("_lines").cast("bigint"), F.size("_left").cast("bigint")
    return done.select(*keep, n.alias("n_lines"), (n - m).alias("n_dropped"), F.array_join("_left", "\n").alias("text"))
