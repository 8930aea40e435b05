"""Add the two ids of the detail page to law-223 notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticemill.functions import text
from noticemill.operators.skew import key_counts, skew_join

# The site a detail link has to end at, and the mark of the id link.
DETAIL_HOST = "zakupki"
PFID_MARK = "pfid"


def redirected_url(final_url: Column, host: str = DETAIL_HOST) -> Column:
    """Where a detail link ended; NULL when that is not the site that has the ids."""
    return F.when(F.contains(final_url, F.lit(host)), final_url)


def detail_ids(details: DataFrame, host: str = DETAIL_HOST) -> DataFrame:
    """(href, ids) of each landed page; `ids` holds noticeinfoid and pfid or is NULL."""
    info = text.notice_info_id(redirected_url(F.col("final_url"), host))
    pfid = text.pfid(text.first_link_with(F.split("icon_hrefs", " "), PFID_MARK))
    both = F.when(info.isNotNull() & pfid.isNotNull(), F.struct(info.alias("noticeinfoid"), pfid.alias("pfid")))
    return details.select("href", both.alias("ids"))


def enrich_223(collected: DataFrame, details: DataFrame, host: str = DETAIL_HOST) -> DataFrame:
    """Distinct collected rows with noticeinfoid and pfid, NULL when the page has none.

    Every row stays: a number without a landed page is reported without ids. Only pages of
    the collected links are looked at, each distinct link once, and only its short ids move. Of a page landed several times the
    version with ids counts, if there are more the largest pair.
    """
    per_link = key_counts(collected, ["href"])
    wanted = details.join(per_link.select("href"), "href", "left_semi")
    found = detail_ids(wanted, host).groupBy("href").agg(F.max("ids").alias("ids"))
    rows = skew_join(collected.distinct(), found, ["href"], "left", counts=per_link)
    return rows.select(*collected.columns, "ids.noticeinfoid", "ids.pfid")
