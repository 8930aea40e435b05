"""Test tables derived from the given Parquet tables (see FIXTURES.md).

The SQL texts run unchanged in Spark and in DuckDB; `{name}` stands for a table or for
another fixture.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticemill.functions.text import encode_cyrillic
from noticemill.operators.skew import number_rows
from noticemill.session import new_path

FIXTURE_SQL = {
    "notices": """
select o_orderkey as notice_id, case when o_orderkey % 2 = 0 then '44' else '223' end as law,
 case when o_orderkey % 10 = 8 then lpad(cast(o_orderkey as string), 18, '0')
      when o_orderkey % 2 = 0 then lpad(cast(o_orderkey as string), 19, '0')
      when o_orderkey % 10 = 9 then '4' || lpad(cast(o_orderkey as string), 10, '0')
      when o_orderkey % 10 = 7 then '3' || lpad(cast(o_orderkey as string), 9, '0')
      else '3' || lpad(cast(o_orderkey as string), 10, '0') end as notice_num,
 cast(o_orderdate as date) as published_on, o_custkey % 20 as search_id from {orders}""",
    "registry": """
select o_orderkey as id_notification, n.notice_num as notificationnumber, n.law
 from {orders} o join {notices} n on n.notice_id = o.o_orderkey where o.o_orderstatus = 'F'""",
    # known numbers of which some lack the id, and some have one row with and one without
    "registry_gaps": """
select case when notice_id % 3 = 0 then null else notice_id end as id_notification, notice_num as notificationnumber, law
 from {notices} where notice_id % 4 < 2
 union all select notice_id, notice_num, law from {notices} where notice_id % 12 = 0""",
    "detail_pages": """
select 'https://t.example/n/' || notice_num as href,
 case when notice_id % 11 = 0 then 'https://t.example/n/' || notice_num
      when notice_id % 13 = 0 then 'https://zakupki.example/404'
      else 'https://zakupki.example/view?x=1&noticeInfoId=' || cast(notice_id + 1000000 as string) end as final_url,
 'https://zakupki.example/print?id=1 https://zakupki.example/doc?pfid=' || cast(notice_id + 5000000 as string) as icon_hrefs
 from {notices} where law = '223' and notice_id % 5 <> 0""",
    "items": """
select p_partkey as item_id, lpad(cast(10 + p_partkey % 5 as string), 2, '0') || '.' || cast(cast(floor(p_partkey / 5) as int) % 9 + 1 as string) || cast(p_partkey % 10 as string) || '.' || cast(p_partkey % 4 as string) || cast(p_partkey % 3 as string) || '.' || cast(100 + p_partkey % 200 as string) as code from {part}""",
    "code_tree": """
select distinct code from (select substring(code,1,2) as code from {items} union all select substring(code,1,4) from {items} union all select substring(code,1,5) from {items} union all select substring(code,1,7) from {items} union all select substring(code,1,8) from {items} union all select substring(code,1,11) || '0' from {items} union all select code from {items}) t""",
    "lists": """
select * from (values ('kw_a',1,'tion'),('kw_a',2,' License '),('kw_b',1,'que'),('kw_b',2,'zzqq'),('kw_b',3,''),('kw_c',1,'the')) as t(list_id, pos, raw_term)""",
    "code_lists": """
select * from (values ('okpd_a',1,'10.10.00.100'),('okpd_a',2,'11.1'),('okpd_a',3,'99.99'),('okpd_b',1,'88.1'),('okpd_b',2,'22.102')) as t(list_id, pos, raw_term)""",
    # raw lines of list files, 200 to a file: padded, blank, Cyrillic, with NBSP
    "raw_lines": """
select 'part_' || lpad(cast(cast(floor(p_partkey / 200) as int) as string), 6, '0') as list_id, cast(p_partkey % 200 + 1 as int) as pos,
 case when p_partkey % 7 = 3 then '' when p_partkey % 7 = 4 then '   ' || p_name || chr(9)
      when p_partkey % 7 = 5 then chr(160) || 'сосна ' || p_name || chr(160) when p_partkey % 7 = 6 then 'Ёлки-' || cast(p_partkey as string)
      else p_name end as raw_term from {part}""",
}

# Same rows as the window in FIXTURES.md over (partition by search_id order by notice_id).
SEARCH_CARDS_SQL = """
select search_id, cast(floor((rn - 1) / 10) + 1 as int) as page_num, cast((rn - 1) % 10 as int) as card_pos, law,
 case when notice_id % 97 = 0 then 'Извещение без номера' when notice_id % 3 = 0 then 'Извещение №' || notice_num when notice_id % 3 = 1 then 'Извещение № ' || notice_num else 'Извещение №' || chr(160) || notice_num end as label,
 'https://t.example/n/' || notice_num as href
 from {numbered_notices} x
 where not (search_id % 7 = 3 and floor((rn - 1) / 10) + 1 = 4)"""

NUMBERED_NOTICES_SQL = "(select n.*, row_number() over (partition by search_id order by notice_id) as rn from {notices} n)"



# The fixtures that stand for landed tables, and the column they are partitioned by.
LANDED = {
    "notices": "law",
    "registry": "law",
    "detail_pages": None,
    "search_cards": None,
    "search_pages": None,
    "items": None,
    "code_tree": None,
}

# Rows of one landed file: small ones, so that even small tables are read by several tasks.
FILE_ROWS = 20_000

# Where they were written and their schema, by application, source folder and name.
_landed_at: dict[tuple[str, str, str], tuple[str, StructType]] = {}


class Fixtures:
    """The given tables and the fixtures as DataFrames.

    Fixtures in `LANDED` are written to the shared folder when first asked for, as the
    engine reads landed tables; the others are views.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in LANDED:
            return self._land(name)
        if name in FIXTURE_SQL:
            return self._sql(FIXTURE_SQL[name])
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _land(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _landed_at:
            own = getattr(type(self), f"derived_{name}", None)
            derived = own(self) if own else self._sql(FIXTURE_SQL[name])
            path, by = new_path(self.spark, name), LANDED[name]
            writer = derived.write if by is None else derived.hint("rebalance", by).write.partitionBy(by)
            writer.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
            _landed_at[key] = path, derived.schema
        path, schema = _landed_at[key]
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)

    def _sql(self, sql: str, **tables: DataFrame) -> DataFrame:
        names = re.findall(r"\{(\w+)\}", sql)
        return self.spark.sql(sql, **{n: tables.get(n) if n in tables else getattr(self, n) for n in names})

    def derived_code_tree(self) -> DataFrame:
        """The rows of the `code_tree` SQL from one pass over the items."""
        cuts = [F.substring("code", 1, n) for n in (2, 4, 5, 7, 8)]
        group = F.concat(F.substring("code", 1, 11), F.lit("0"))
        return self.items.select(F.explode(F.array(*cuts, group, "code")).alias("code")).distinct()

    @property
    def hrefs(self) -> DataFrame:
        """Notices with their link."""
        return self.notices.withColumn("href", F.concat(F.lit("https://t.example/n/"), "notice_num"))

    def derived_search_cards(self) -> DataFrame:
        numbered = number_rows(self.notices, ["search_id"], "notice_id").withColumn("rn", F.col("row_pos") + 1)
        return self._sql(SEARCH_CARDS_SQL, numbered_notices=numbered)

    def derived_search_pages(self) -> DataFrame:
        """Result pages as HTML; a page has at most ten cards."""
        card = F.concat(
            F.lit('<div class="card-item wide"><div class="card-item__about"><br><a class="t" href="'),
            F.col("href"),
            F.lit('">'),
            F.col("label"),
            F.lit('</a><a href="/print">print</a></div><a href="/more">more</a></div>'),
        )
        cards = F.transform(F.array_sort(F.collect_list(F.struct("card_pos", card.alias("html")))), lambda c: c.html)
        html = F.concat(
            F.lit('<html><body><a href="/">home</a><div id="content">'),
            F.array_join(cards, "\n"),
            F.lit('</div><ul id="pager"><li><a class="page-link" href="#">1</a></li></ul></body></html>'),
        )
        return self.search_cards.groupBy("search_id", "page_num").agg(html.alias("html"))

    @property
    def list_files(self) -> DataFrame:
        """(list_id, content): the raw lines as file bytes, every other file in windows-1251."""
        term = F.col("raw_term")
        utf8 = F.hex(F.encode(term, "UTF-8"))
        line = F.when(F.substring("list_id", -1, 1).isin(*"13579"), F.hex(encode_cyrillic(term))).otherwise(utf8)
        lines = self.raw_lines.select("list_id", F.struct("pos", line.alias("hex")).alias("line"))
        joined = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x.hex), "0D0A")
        return lines.groupBy("list_id").agg(F.unhex(joined).alias("content"))

    def write_list_files(self, path: str) -> None:
        """One UTF-8 text file per list below `path`, lines in order."""
        (
            self.raw_lines.repartition("list_id")
            .sortWithinPartitions("list_id", "pos")
            .select("list_id", "raw_term")
            .write.partitionBy("list_id")
            .text(path)
        )


def with_fixtures(body: str, names: Iterable[str]) -> str:
    """DuckDB SQL: `body` with the named fixtures, and those they need, as CTEs."""
    texts = dict(FIXTURE_SQL)
    texts["search_cards"] = SEARCH_CARDS_SQL.replace("{numbered_notices}", NUMBERED_NOTICES_SQL)
    order: list[str] = []

    def need(name: str) -> None:
        if name in texts and name not in order:
            for other in re.findall(r"\{(\w+)\}", texts[name]):
                need(other)
            order.append(name)

    for name in names:
        need(name)
    ctes = [f"{n} as ({re.sub(r'[{}]', '', texts[n]).strip()})" for n in order]
    return f"with {', '.join(ctes)} {body.strip()}" if ctes else body.strip()
