"""Keyed state behind the streaming jobs.

Of a finished reply one number stays, so that repeats of its chunks are not told again; a time to live drops it.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _chunks(frame: pd.DataFrame) -> Iterator[tuple[int, str]]:
    """Chunks by number; a null chunk is an empty one."""
    return zip(frame["seq"].tolist(), ("" if chunk is None else chunk for chunk in frame["chunk"].tolist()))


class _Forgetting(StatefulProcessor):
    """Drops all that is kept of a reply, its mark of being told included, once the watermark has passed its last
    chunk. The watermark is as far behind as a reply may be silent."""

    def __init__(self, ttl_ms: int | None = None, forgets: bool = False) -> None:
        self.ttl_ms = ttl_ms
        self.forgets = forgets

    def watch(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heard = handle.getValueState("heard", "at bigint", self.ttl_ms)

    def hear(self, frames: list[pd.DataFrame]) -> None:
        if not self.forgets:
            return
        newest = max(int(frame["ts"].max().timestamp() * 1000) for frame in frames)
        stored = self.heard.get()
        if stored:
            newest = max(newest, stored[0])
            self.handle.deleteTimer(stored[0])
        self.handle.registerTimer(newest)
        self.heard.update((newest,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in (self.heard, *self.kept()):
            state.clear()
        return iter(())

    def close(self) -> None:
        pass


class AssembleReplies(_Forgetting):
    """Collects the chunks of a reply by number and emits the text once all up to the last are there."""

    def kept(self) -> list:
        return [self.waiting, self.last, self.done]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.watch(handle)
        self.waiting = handle.getMapState("waiting", "seq bigint", "chunk string", self.ttl_ms)
        self.last = handle.getValueState("last", "seq bigint", self.ttl_ms)
        self.done = handle.getValueState("done", "at bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        self.hear(frames)
        if self.done.exists():  # a repeat of what has been told
            return
        new: dict[int, str] = {}
        last = None
        for frame in frames:
            new.update(_chunks(frame))
            ends = frame.loc[frame["is_last"], "seq"]
            if len(ends):
                last = int(ends.iloc[0])
        chunks = dict(new)
        for (seq,), (chunk,) in self.waiting.iterator():
            chunks.setdefault(seq, chunk)
        stored = self.last.get()
        last = last if last is not None else (stored[0] if stored else None)
        if last is None or len(chunks) <= last:
            for seq, chunk in new.items():
                self.waiting.updateValue((seq,), (chunk,))
            if last is not None:
                self.last.update((last,))
            return
        self.waiting.clear()
        self.last.clear()
        self.done.update((last,))
        text = "".join(chunks[seq] for seq in sorted(chunks) if chunks[seq].strip())
        yield pd.DataFrame({"rid": [key[0]], "response": [text]})


# The tags that mean something in each section, and the section they lead to.
TAGS = {
    "text": {"<reasoning>": "reasoning", "<output>": "output"},
    "reasoning": {"</reasoning>": "text"},
    "output": {"</output>": "text"},
}


def _held_back(buffer: str, tags) -> int:
    """Length of the longest end of `buffer` that may be the start of a tag."""
    for size in range(min(len(buffer), max(map(len, tags)) - 1), 0, -1):
        if any(tag.startswith(buffer[-size:]) for tag in tags):
            return size
    return 0


def read_sections(section: str, buffer: str, final: bool) -> tuple[list[tuple[str, str]], str, str]:
    """Pieces (section, text) that are certain, then the section and the text still open."""
    pieces = []
    while True:
        tags = TAGS[section]
        found = re.search("|".join(map(re.escape, tags)), buffer)
        if not found:
            break
        if found.start():
            pieces.append((section, buffer[: found.start()]))
        section, buffer = tags[found.group()], buffer[found.end() :]
    keep = 0 if final else _held_back(buffer, TAGS[section])
    done = buffer[: len(buffer) - keep]
    if done:
        pieces.append((section, done))
    return pieces, section, buffer[len(buffer) - keep :]


class TagSections(_Forgetting):
    """Cuts replies into tagged sections chunk by chunk; early chunks wait for their turn."""

    def kept(self) -> list:
        return [self.place, self.early, self.done]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.watch(handle)
        self.place = handle.getValueState(
            "place", "section string, buffer string, next_seq bigint, piece_no bigint, last_seq bigint", self.ttl_ms
        )
        self.early = handle.getMapState("early", "seq bigint", "chunk string", self.ttl_ms)
        self.done = handle.getValueState("done", "at bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        self.hear(frames)
        if self.done.exists():  # a repeat of what has been told
            return
        stored = self.place.get()
        section, buffer, next_seq, piece_no, last = stored if stored else ("text", "", 0, 0, -1)
        new: dict[int, str] = {}
        for frame in frames:
            new.update(_chunks(frame))
            ends = frame.loc[frame["is_last"], "seq"]
            if len(ends):
                last = int(ends.iloc[0])

        ready = []
        while True:
            if next_seq in new:
                ready.append(new.pop(next_seq))
            elif stored and self.early.containsKey((next_seq,)):
                ready.append(self.early.getValue((next_seq,))[0])
                self.early.removeKey((next_seq,))
            else:
                break
            next_seq += 1
        final = last >= 0 and next_seq > last
        pieces, section, buffer = read_sections(section, buffer + "".join(ready), final)

        if final:
            self.place.clear()
            self.early.clear()
            self.done.update((last,))
        else:
            for seq, chunk in new.items():
                if seq > next_seq:
                    self.early.updateValue((seq,), (chunk,))
            self.place.update((section, buffer, next_seq, piece_no + len(pieces), last))
        if pieces:
            yield pd.DataFrame(
                {
                    "rid": key[0],
                    "piece_no": range(piece_no, piece_no + len(pieces)),
                    "section": [p[0] for p in pieces],
                    "text": [p[1] for p in pieces],
                }
            )


class ReplaySessions(StatefulProcessor):
    """Carries sessions over the ranges of a log: what a session has in force and where its open conversation is.

    A row is a range's closing (`operators.replay.closings`); the answer to it is where the range starts. The
    history of the open conversation is kept as the ranges that hold it, a small row for each. Ranges of a
    micro-batch that was told before are told once.
    """

    EMPTY = (0, 0, 0, None, None, False, -1, -1)

    def __init__(self, forgets: bool = False) -> None:
        self.forgets = forgets

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.session = handle.getValueState(
            "session",
            "conversation bigint, messages bigint, chars bigint, system string, temperature double, ended boolean, "
            "batch bigint, last bigint",
        )
        self.history = handle.getListState("history", "batch bigint, range_no int, first bigint, news bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.session.get()
        conversation, messages, chars, system, temperature, ended, told, last = stored or self.EMPTY
        before, kept, new = told, True, []
        for r in sorted(rows, key=lambda r: (r.batch, r.range_no)):
            if r.batch <= before:
                continue
            yield Row(
                user_id=key[0],
                batch=r.batch,
                range_no=r.range_no,
                conversation=conversation,
                messages=messages,
                chars=chars,
                system=system,
                temperature=temperature,
                ended=ended,
            )
            told, last = r.batch, max(last, int(r.ts.timestamp() * 1000))
            if ended:
                continue
            if r.news:
                conversation, messages, chars, kept, new = conversation + r.news, 0, 0, False, []
            if r.said:
                new.append((r.batch, r.range_no, messages, r.news))
            messages, chars = messages + r.said, chars + r.chars
            system = r.system if r.system is not None else system
            temperature = r.temperature if r.temperature is not None else temperature
            ended = bool(r.exits)
        if told == before:
            return
        if stored and not kept:
            self.history.clear()
        if new:
            self.history.appendList(new)
        self.session.update((conversation, messages, chars, system, temperature, ended, told, last))
        if self.forgets:
            if stored:
                self.handle.deleteTimer(stored[-1])
            self.handle.registerTimer(last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The watermark is as far behind as a session may be idle, so one whose last row it has passed is gone."""
        self.session.clear()
        self.history.clear()
        return iter(())

    def close(self) -> None:
        pass
