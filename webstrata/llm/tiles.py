"""Tiles of an all-pairs search: a block of rows that ask, and a span of blocks that tasks read from the shared folder.

The blocks lie there once. A copy of them for each tile would grow with the square of the input, in a shuffle as in a
broadcast, and the planner, which knows the files but not how often they are copied, takes such a side for a small one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import fresh_dir
from ..sources.task_files import file_system, qualified

#: Tiles that a search is cut into at least; where fewer blocks ask, what they read is cut into spans.
LEAST_TILES = 48


class Stored:
    """Rows with a column ``dim`` and binary ones, written to the shared folder and read in tasks, one at a time.

    The folder has to be on a file system that ``pyarrow.fs`` knows."""

    def __init__(self, blocks: DataFrame, name: str):
        path = fresh_dir(blocks.sparkSession, name)
        blocks.write.parquet(path)
        self.folder = qualified(blocks.sparkSession, path)
        system, at = file_system(self.folder)
        names = sorted(x.base_name for x in system.get_file_info(fs.FileSelector(at)) if x.base_name.startswith("part-"))
        self.files = [(x, pq.read_metadata(f"{at}/{x}", filesystem=system).num_rows) for x in names]
        self.count = sum(rows for _, rows in self.files)

    def spans(self, groups: int) -> int:
        """How many spans ``groups`` blocks that ask are searched in."""
        return max(1, min(self.count, -(-LEAST_TILES // groups)))

    def read(self, span: int, spans: int, dim: int, *columns: str) -> Iterator[list[bytes]]:
        """The blocks of a span that have this ``dim``."""
        system, at = file_system(self.folder)
        first, last = span * self.count // spans, (span + 1) * self.count // spans
        place = 0
        for name, rows in self.files:
            if place < last and first < place + rows:
                with system.open_input_file(f"{at}/{name}") as source:
                    file = pq.ParquetFile(source, buffer_size=1 << 20, pre_buffer=False)
                    for i, batch in enumerate(file.iter_batches(1, columns=["dim", *columns], use_threads=False), place):
                        if i >= last:
                            break
                        if i >= first and batch.column("dim")[0].as_py() == dim:
                            yield [batch.column(c)[0].as_py() for c in columns]
            place += rows


def dealt(asking: DataFrame, groups: int, spans: int) -> DataFrame:
    """Each of some ``groups`` rows once for each span, numbered ``part``; as many to one task as to another."""
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spans - 1).cast("long")))
    return asking.withColumn("part", parts).repartition(groups * spans)


def first(scores: np.ndarray, k: int) -> np.ndarray:
    """Where the ``k`` highest scores are; of equal ones the first."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])


class Best:
    """The ``k`` best of each row so far: by score, of equal scores by the smaller id, repeated ones as often as they come."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.scores, self.ids = np.zeros((rows, k), np.int64), np.zeros((rows, k), np.int64)
        self.filled = np.zeros(rows, np.int64)

    def least(self, rows: np.ndarray, kind: type) -> np.ndarray:
        """What a score has to be at least to be among the best of these rows, as a column of that kind.

        A bound that the kind can't hold is rounded beyond all scores that it holds exactly."""
        anything = -np.inf if issubclass(kind, np.floating) else np.iinfo(kind).min
        return np.where(self.filled[rows] == self.k, self.scores[rows, -1].astype(kind), kind(anything))[:, None]

    def add(self, rows: np.ndarray, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray) -> None:
        """Take in the scores that ``fits`` marks (it is changed): a line for each of these rows, a column for each id in order."""
        if np.count_nonzero(fits) > 4 * self.k * len(rows):
            for line, one in zip(fits, scores):
                there = np.flatnonzero(line)
                if len(there) > self.k:
                    line[:] = False
                    line[there[first(one[there], self.k)]] = True
        flat = np.flatnonzero(fits)
        if not len(flat):
            return
        line, place = np.divmod(flat, fits.shape[1])
        lines = np.unique(line)
        own = rows[lines]
        held = np.arange(self.k) < self.filled[own][:, None]
        line = np.concatenate([np.repeat(lines, self.filled[own]), line])
        score = np.concatenate([self.scores[own][held], scores.ravel()[flat].astype(np.int64)])
        id_of = np.concatenate([self.ids[own][held], ids[place]])
        order = np.lexsort((id_of, ~score, line))
        line = line[order]
        begin, end = np.searchsorted(line, lines, "left"), np.searchsorted(line, lines, "right")
        rank = np.arange(len(line)) - np.repeat(begin, end - begin)
        kept = rank < self.k
        to = rows[line[kept]], rank[kept]
        self.scores[to], self.ids[to] = score[order][kept], id_of[order][kept]
        self.filled[own] = np.minimum(end - begin, self.k)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows that have any, where the list of each begins (and the last ends), and all scores and ids."""
        rows = np.flatnonzero(self.filled)
        held = np.arange(self.k) < self.filled[:, None]
        return rows, np.concatenate([[0], np.cumsum(self.filled[rows])]), self.scores[held], self.ids[held]
