"""Result pages that land in any order: cards leave once their pages are without a gap."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from noticemill.session import stage
from noticemill.sources.html import scan_result_cards
from noticemill.streaming.intake import MAX_FILE_AGE
from noticemill.streaming.reruns import stream_settings

PAGE_SCHEMA = "search_id bigint, page_num int, html string"
# A page that is handed on, or one given up: its search waited too long for a page before it.
RELEASED = "search_id bigint, page_num int, html string, given_up boolean"
# Page numbers of one block of waiting pages, and what a task holds before it adds to the blocks.
BLOCK_PAGES = 256
HELD_PAGES = 4096
HELD_CHARACTERS = 16_000_000


class PagesInOrder(StatefulProcessor):
    """Per search the page it waits for, and the pages landed beyond it.

    A search's pages are handled as they come, some hundred at a time. Those that wait are
    kept by blocks of `BLOCK_PAGES` page numbers; what a batch adds to a block is an entry of
    its own, so the state is asked once for many pages, and a search may have any number.
    """

    def __init__(self, patience_ms: int | None) -> None:
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.search = handle.getValueState("search", "next int, moved_ms bigint")
        self.entries = handle.getMapState("entries", "block int", "n int")
        self.waiting = handle.getMapState("waiting", "block int, entry int", "pages array<int>, htmls array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        known = self.search.exists()
        first, moved = self.search.get() if known else (1, now)
        following, held, buffer, size = first, False, [], 0
        for part in rows:
            out = []
            for page, html in sorted(zip(part["page_num"], part["html"]), key=lambda row: row[0]):
                if page <= following:  # the awaited one, or one that was handed on before and lands again
                    out.append((page, html))
                    following = max(following, page + 1)
                else:
                    buffer.append((page, html))
                    size += len(html or "")
            if len(buffer) >= HELD_PAGES or size >= HELD_CHARACTERS:
                self._hold(buffer)
                held, buffer, size = True, [], 0
            yield self._pages(key, out, False)
        if buffer:
            self._hold(buffer)
            held = True
        # the awaited page of a search that has not moved is not among the waiting ones
        block = first // BLOCK_PAGES
        while following != first and block <= following // BLOCK_PAGES:
            found = self.entries.getValue((block,))
            out, left = [], []
            for page, html in sorted(self._drop(block, found[0]) if found else [], key=lambda row: row[0]):
                if page <= following:
                    out.append((page, html))
                    following = max(following, page + 1)
                else:
                    left.append((page, html))
            self._hold(left)
            if out:
                yield self._pages(key, out, False)
            block += 1
        if following != first:
            moved = now
        if following != first or not known:
            self.search.update((following, moved))
        if self.patience_ms is not None and (held or self.waiting.exists()):
            self.handle.registerTimer(now + self.patience_ms)

    def _hold(self, rows: list[tuple]) -> None:
        """Add pages to those that wait: one entry in each block they are of."""
        blocks: dict[int, list[tuple]] = {}
        for row in rows:
            blocks.setdefault(row[0] // BLOCK_PAGES, []).append(row)
        for block, own in blocks.items():
            found = self.entries.getValue((block,))
            n = found[0] if found else 0
            self.waiting.updateValue((block, n), ([int(page) for page, _ in own], [html for _, html in own]))
            self.entries.updateValue((block,), (n + 1,))

    def _drop(self, block: int, n: int) -> list[tuple]:
        """The pages of a block, which no longer wait."""
        rows = []
        for entry in range(n):
            pages, htmls = self.waiting.getValue((block, entry))
            rows += zip(pages, htmls)
            self.waiting.removeKey((block, entry))
        self.entries.removeKey((block,))
        return rows

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Give up the waiting pages of a search that has not moved for so long."""
        _, moved = self.search.get() if self.search.exists() else (1, 0)
        if timerValues.getCurrentProcessingTimeInMs() - moved >= self.patience_ms and self.waiting.exists():
            for _, (pages, htmls) in self.waiting.iterator():
                yield self._pages(key, list(zip(pages, htmls)), True)
            self.waiting.clear()
            self.entries.clear()

    def _pages(self, key, pages: list[tuple], given_up: bool) -> pd.DataFrame:
        return pd.DataFrame([(key[0], page, html, given_up) for page, html in pages], columns=["search_id", "page_num", "html", "given_up"])

    def close(self) -> None:
        pass


def stream_pages(
    spark: SparkSession,
    landed: str,
    out: str,
    checkpoint: str,
    schema: StructType | str = PAGE_SCHEMA,
    files_per_batch: int = 1000,
    patience_ms: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> StreamingQuery:
    """Append the cards of pages 1, 2, 3 … of each search to Parquet, in whatever order pages land.

    Cards of a page beyond a missing one wait, over any number of runs, until the gap is
    filled. A page that lands twice gives its cards twice, as in the batch form; pages
    without a search or a positive number are left out. With `patience_ms` a search that has
    not moved for so long when a later batch runs gives its waiting pages up: they are
    listed with `given_up` true and no longer wait. Written are (search_id, page_num,
    card_pos, label, href, given_up); a page given up is one row without a card. Files more than `max_file_age` older than the newest one seen are
    not read.
    """
    pages = (
        spark.readStream.format("parquet")
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", max_file_age)
        .load(landed)
    )
    pages = pages.filter("search_id is not null and page_num >= 1").select(
        F.col("search_id").cast("bigint"), F.col("page_num").cast("int"), "html"
    )
    released = pages.groupBy("search_id").transformWithStateInPandas(
        PagesInOrder(patience_ms), RELEASED, outputMode="Append", timeMode="ProcessingTime"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = stage(batch, "released-pages")  # read twice below; the state is to be asked once
        cards = scan_result_cards(batch.filter("not given_up"))
        left = batch.filter("given_up").select("search_id", "page_num", "given_up")
        rows = cards.unionByName(left, allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with stream_settings(spark):
        return (
            released.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
