"""A paged service as a Spark source; the fetch is given.

Where totals are known, one task reads one page. Where they are not, or not to be trusted, one task reads a search
until a page comes back empty or short, as a batch or as a stream that goes on where it stopped.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS = "search_no int, search string, page int, pos int, raw_json string"


class PageOf(InputPartition):
    def __init__(self, search_no: int, search: str, page: int, request: Mapping):
        self.search_no, self.search, self.page, self.request = search_no, search, page, request


def read_pages_of(
    spark: SparkSession,
    requests: Iterable[tuple[str, int, Mapping]],
    fetch: Callable[[Mapping], list[Mapping]],
    name: str = "paged_offers",
) -> DataFrame:
    """Rows (search_no, search, page, pos, raw_json) of all requested pages.

    ``requests`` lists (search, page, request), searches in the order they count for
    deduplication. ``fetch`` runs in the tasks and returns the records of one page; a page
    that fails is retried by Spark like any task.
    """
    numbers: dict[str, int] = {}
    plan = [
        PageOf(numbers.setdefault(search, len(numbers)), search, page, dict(request))
        for search, page, request in requests
    ]

    class Reader(DataSourceReader):
        def partitions(self):
            return plan

        def read(self, part):
            for pos, record in enumerate(fetch(part.request)):
                yield part.search_no, part.search, part.page, pos, json.dumps(record, ensure_ascii=False)

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return ROWS

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Paged)
    return spark.read.format(name).load()


Fetch = Callable[[Mapping, int], list[Mapping]]


class Pages(InputPartition):
    """Pages ``first`` to ``last`` of a search (to the end, if None)."""

    def __init__(self, search_no: int, search: str, request: Mapping, first: int, last: int | None):
        self.search_no, self.search, self.request = search_no, search, request
        self.first, self.last = first, last


class OpenSearches:
    """What all searches have in common: the fetch, the size of a full page and the most results of a search."""

    def __init__(self, searches: Iterable[tuple[str, Mapping]], fetch: Fetch, page_size: int, most_results: int | None):
        if page_size < 1:
            raise ValueError("a page holds at least one record")
        self.searches = [(n, search, dict(request)) for n, (search, request) in enumerate(searches)]
        self.fetch, self.page_size, self.most_results = fetch, page_size, most_results

    def read(self, part: Pages, ended: Callable[[int], None] = lambda page: None) -> Iterator[tuple]:
        """Rows of the pages, up to the first that is empty or short, or where the most results are reached; ``ended`` is told it."""
        page = part.first
        while part.last is None or page <= part.last:
            wanted = self.page_size
            if self.most_results is not None:
                wanted = min(wanted, self.most_results - (page - 1) * self.page_size)
            records = self.fetch(part.request, page)[:wanted] if wanted > 0 else []
            for pos, record in enumerate(records):
                yield part.search_no, part.search, page, pos, json.dumps(record, ensure_ascii=False)
            if len(records) < self.page_size:
                ended(page)
                return
            page += 1


def read_searches(
    spark: SparkSession,
    searches: Iterable[tuple[str, Mapping]],
    fetch: Fetch,
    page_size: int,
    most_results: int | None = None,
    name: str = "open_searches",
) -> DataFrame:
    """Rows (search_no, search, page, pos, raw_json) of all pages of all searches, whatever total a service tells.

    ``searches`` lists (search, request); ``fetch(request, page)`` runs in the tasks and returns the records of a page,
    pages counted from 1. A search is one task, as only a page tells whether another follows.
    """
    found = OpenSearches(searches, fetch, page_size, most_results)

    class Reader(DataSourceReader):
        def partitions(self):
            return [Pages(*s, 1, None) for s in found.searches]

        def read(self, part):
            return found.read(part)

    class Searches(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return ROWS

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Searches)
    return spark.read.format(name).load()


class Progress:
    """Files in a shared folder: the rounds that were planned, and in which round each search ended."""

    def __init__(self, folder: str):
        self.folder = folder

    def _store(self) -> tuple[fs.FileSystem, str]:
        store, root = fs.FileSystem.from_uri(self.folder if ":" in self.folder else f"file://{self.folder}")
        store.create_dir(root, recursive=True)
        return store, root

    def note(self, mark: str, number: int, round_: int) -> None:
        store, root = self._store()
        store.open_output_stream(f"{root}/{mark}-{number}-{round_}").close()

    def noted(self, mark: str) -> dict[int, int]:
        """The first round noted for each number."""
        store, root = self._store()
        out: dict[int, int] = {}
        for file in store.get_file_info(fs.FileSelector(root)):
            kind, _, rest = file.base_name.partition("-")
            if kind == mark:
                number, _, round_ = rest.partition("-")
                out[int(number)] = min(int(round_), out.get(int(number), int(round_)))
        return out


def stream_searches(
    spark: SparkSession,
    searches: Sequence[tuple[str, Mapping]],
    fetch: Fetch,
    page_size: int,
    progress: str,
    pages_per_round: int = 20,
    most_results: int | None = None,
    name: str = "open_search_stream",
) -> DataFrame:
    """The rows of ``read_searches`` as a stream: each round reads up to ``pages_per_round`` further pages of every search.

    A batch takes as many rounds as there were before it, the first one round, so that long searches need few batches;
    in a batch a search is one task over the pages of all its rounds. The offset is the number of the round, so a stream started again with its checkpoint and the same ``progress``
    folder (one that all executors reach) goes on with the next pages and fetches none twice; a batch that failed is
    read again whole. A search that ended in a round takes no part in later ones.
    """
    found, state = OpenSearches(searches, fetch, page_size, most_results), Progress(progress)

    class Reader(DataSourceStreamReader):
        def initialOffset(self):
            return {"round": 0}

        def latestOffset(self):
            planned, ended = max(state.noted("planned").values(), default=0), state.noted("ended")
            open_ = any(n not in ended or ended[n] > planned for n, _, _ in found.searches)
            return {"round": planned + (max(planned, 1) if open_ else 0)}

        def partitions(self, start, end):
            if start["round"] == end["round"]:
                return []
            ended, first = state.noted("ended"), start["round"] + 1
            state.note("planned", end["round"], end["round"])
            return [
                Pages(*search, start["round"] * pages_per_round + 1, end["round"] * pages_per_round)
                for search in found.searches
                if ended.get(search[0], first) >= first
            ]

        def read(self, part):
            return found.read(part, lambda page: state.note("ended", part.search_no, (page - 1) // pages_per_round + 1))

    class Searches(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return ROWS

        def streamReader(self, schema):
            return Reader()

    spark.dataSource.register(Searches)
    return spark.readStream.format(name).load()
