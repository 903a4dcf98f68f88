"""S1, L2, L3, ST1 as a stream source of single messages.

The file source of a stream deals out whole files. This source deals out messages: an offset
names the pieces (file, lines) of one or more polls, each of at most ``per_poll`` messages, so a poll is
the same whenever it is read again. Every message carries the number of its ``poll``. A backlog may be taken
in several polls to a micro-batch (``polls``): a batch costs the same few jobs however many it holds.
The driver only counts line ends, in blocks of ``PIECE_BYTES``; tasks read the messages, one piece each. Files are taken in the order of their modification time
(or of their names), a file is finished before the next one is opened, and files that are wholly
consumed are moved to ``_done`` under the inbox once Spark has committed their poll: that is
the acknowledgement, and what lies in the inbox is what is still to be read.

With a ``matched_cap`` the source counts the messages whose name is wanted while it deals
them out; when the cap is met at the end of a poll, no later message is offered, also
after a restart.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from gridspark.sources.netcdf import _filesystem

SOURCE = "polled_messages"
DONE = "_done"
SCHEMA = "file string, line long, body string, poll long"
# Bytes of one piece, read by one task (a longer line is a piece by itself), and rows of its Arrow batches.
PIECE_BYTES = 8 << 20
READ_ROWS = 5000


def message_name(line: bytes) -> str | None:
    """The name field of one message body; None when it cannot be read."""
    try:
        return json.loads(json.loads(line)["Message"].replace("\\\\", ""))["name"]
    except (ValueError, KeyError, TypeError, AttributeError):
        return None


class Piece(InputPartition):
    """Consecutive lines of one file; message ``i`` of all, short polls counted as full ones, is the first."""

    def __init__(self, file: str, line: int, at: int, end: int, i: int):
        self.file, self.line, self.at, self.end, self.i = file, line, at, end, i


class MessageReader(DataSourceStreamReader):
    """Offset: ``poll`` counts the polls dealt out, ``pieces`` [file, first line, first byte, end byte, number of its first
    message] are those of the last batch, the ``open`` file [file, lines, bytes] is read in part, ``done`` [[files finished
    by the last batch], [those of the batch before]] and ``matched`` the messages of all polls that are wanted."""

    def __init__(self, inbox: str, per_poll: int, names: Iterable[str] | None, matched_cap: int | None, by_name: bool, polls: int = 1):
        self.inbox, self.per_poll, self.matched_cap, self.by_name, self.polls = inbox, per_poll, matched_cap, by_name, polls
        self.names = None if names is None else set(names)
        self.at: dict | None = None

    def _fs(self) -> tuple[pafs.FileSystem, str]:
        return _filesystem(self.inbox)

    def initialOffset(self) -> dict:
        return {"poll": 0, "pieces": "[]", "open": "[]", "done": "[[], []]", "matched": 0}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self.initialOffset()
        if self._capped(self.at["matched"]):
            return self.at
        fs, root = self._fs()
        finished = json.loads(self.at["done"])
        opened = json.loads(self.at["open"])
        seen = {f for files in finished for f in files} | set(opened[:1])
        waiting = [(opened[0], opened[1], opened[2])] if opened else []
        waiting += [(f, 0, 0) for f in self._files(fs, root) if f not in seen]
        pieces, done, opened, matched, dealt = [], [], [], self.at["matched"], 0
        first = self.at["poll"] * self.per_poll
        most = self.per_poll * self.polls
        for file, line, at in waiting:
            if dealt == most or self._capped(matched) and dealt % self.per_poll == 0:
                break
            whole = False
            with fs.open_input_file(f"{root}/{file}") as f:
                while not (whole := at >= f.size()):
                    left = most - dealt
                    if self.matched_cap is not None:  # the cap is judged at the end of every poll
                        left = min(left, self.per_poll - dealt % self.per_poll)
                        if self._capped(matched) and dealt % self.per_poll == 0:
                            break
                    if not left:
                        break
                    block, n = self._block(f, at, left)
                    matched += n if self.names is None else sum(message_name(x) in self.names for x in block.removesuffix(b"\n").split(b"\n"))
                    if pieces and pieces[-1][0] == file and at + len(block) - pieces[-1][2] <= PIECE_BYTES:
                        pieces[-1][3] = at + len(block)
                    else:
                        pieces.append([file, line, at, at + len(block), first + dealt])
                    line, at, dealt = line + n, at + len(block), dealt + n
            if whole:
                done.append(file)
            else:
                opened = [file, line, at]
                break
        if pieces or done:
            self.at = {"poll": self.at["poll"] - (-dealt // self.per_poll), "pieces": json.dumps(pieces), "open": json.dumps(opened),
                       "done": json.dumps([done, finished[0]]), "matched": matched}
        return self.at

    def _capped(self, matched: int) -> bool:
        return self.matched_cap is not None and matched >= self.matched_cap

    def _files(self, fs: pafs.FileSystem, root: str) -> list[str]:
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        found = [f for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"]
        return [f.base_name for f in sorted(found, key=lambda f: (0 if self.by_name else f.mtime_ns, f.base_name))]

    @staticmethod
    def _block(f: pa.NativeFile, at: int, most: int) -> tuple[bytes, int]:
        """The whole lines from byte ``at``, up to ``most`` and about ``PIECE_BYTES``, and how many they are. The last
        line of a file needs no end."""
        size = f.size()
        block = f.read_at(min(PIECE_BYTES, most << 10, size - at), at)
        while (cut := block.rfind(b"\n") + 1) == 0 and at + len(block) < size:
            block += f.read_at(min(PIECE_BYTES, size - at - len(block)), at + len(block))
        if at + len(block) == size:
            cut = len(block)
        n = block.count(b"\n", 0, cut)
        if n > most or n == most and block[cut - 1: cut] != b"\n":
            cut, n = int(np.flatnonzero(np.frombuffer(block, np.uint8) == 10)[most - 1]) + 1, most
        elif block[cut - 1: cut] != b"\n":
            n += 1
        return block[:cut], n

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        if self.at is None:  # after a restart: go on from the last poll that was planned
            self.at = end
        return [] if start == end else [Piece(*p) for p in json.loads(end["pieces"])]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        fs, root = self._fs()
        with fs.open_input_file(f"{root}/{partition.file}") as f:
            lines = f.read_at(partition.end - partition.at, partition.at).split(b"\n")
        if lines[-1] == b"":
            lines.pop()
        for lo in range(0, len(lines), READ_ROWS):
            some = lines[lo: lo + READ_ROWS]
            n, at = len(some), np.arange(lo, lo + len(some), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([partition.file] * n, pa.string()), pa.array(partition.line + at),
                 pa.array([x.removesuffix(b"\r").decode(errors="replace") for x in some], pa.string()),
                 pa.array((partition.i + at) // self.per_poll)], names=["file", "line", "body", "poll"])

    def commit(self, end: dict) -> None:
        fs, root = self._fs()
        fs.create_dir(f"{root}/{DONE}", recursive=True)
        for file in json.loads(end["done"])[0]:
            if fs.get_file_info(f"{root}/{file}").type == pafs.FileType.File:
                fs.move(f"{root}/{file}", f"{root}/{DONE}/{file}")


class MessageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> MessageReader:
        names, most = self.options.get("names"), self.options.get("matchedCap")
        return MessageReader(self.options["path"], int(self.options.get("messagesPerPoll", "10")),
                             None if names is None else json.loads(names), None if most is None else int(most),
                             self.options.get("fileOrder", "time") == "name", int(self.options.get("pollsPerBatch", "1")))


def polled_messages(spark: SparkSession, inbox: str, per_poll: int, names: Iterable[str] | None = None,
                    matched_cap: int | None = None, file_order: str = "time", polls: int = 1) -> DataFrame:
    """ST1/L2: (file, line, body, poll) of the messages in ``inbox``, at most ``per_poll`` in each
    poll and up to ``polls`` polls in each micro-batch when so many wait, files in the order of their modification ``"time"`` or their ``"name"``. ``matched_cap`` (L3) ends the stream's supply after the poll in which that many messages
    named in ``names`` (any message without it) were dealt out.

    Files must appear whole (written elsewhere and moved in); names starting with ``.`` or ``_`` are
    left alone. One query consumes an inbox: files it has finished are moved to ``_done``.
    Use a processing-time trigger; ``drained`` runs such a stream until nothing more is offered.
    """
    spark.dataSource.register(MessageSource)
    reader = spark.readStream.format(SOURCE).option("messagesPerPoll", per_poll).option("fileOrder", file_order).option("pollsPerBatch", polls)
    if names is not None:
        reader = reader.option("names", json.dumps(sorted(names)))
    if matched_cap is not None:
        reader = reader.option("matchedCap", matched_cap)
    return reader.load(inbox)


def drained(query) -> None:
    """Wait until a polled stream has taken all that is offered now, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def idle(query, rounds: int = 2) -> None:
    """Wait until a query whose state keeps time, and so never stops making batches, has taken no row in the last
    ``rounds`` of them, then stop it. However long a batch takes, the wait ends only with rest or the query's failure."""
    try:
        while True:
            if query.exception() is not None:
                raise query.exception()
            if not query.isActive:
                raise RuntimeError("the stream was stopped before it came to rest")
            last = query.recentProgress[-rounds:]
            if len(last) == rounds and all(p["numInputRows"] == 0 for p in last):
                return
            time.sleep(0.2)
    finally:
        query.stop()
