"""Frames of the replication protocol in files, read by many tasks.

A capture is a file or a folder of files in the order of their names, each ``[length: 4 bytes][frame]``, with
whole transactions a file. The driver plans: it walks over the heads of frames (a length and a kind), takes in
what the few Relation and Commit messages say, and cuts the capture into ranges of about ``SIZE`` bytes. It
never sees the values of a change. ``add_frames`` writes an index beside a file (``Index``), so that the walk
reads some hundred bytes for each ``STEP`` of it instead of its frames; files without one are walked over. A range is either some whole transactions or a part of one large
transaction, and knows what its task needs to begin there: the relations, the running ``_seq``, and for a part
the commit that the walk has met behind it. So transactions of any size are decoded by many tasks, none of
which holds more than its range, and ``_seq`` is the same however the capture is cut.

``spooled`` puts what a live connection sends into such a folder, whole transactions at a time, so that a
server's one connection costs the driver a copy of bytes and nothing else.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

from pyspark.sql.datasource import InputPartition

#: Bytes of frames of a range, about, and bytes that the walk reads at once.
SIZE, CHUNK = 8 << 20, 1 << 20
#: Bytes of a block of an index, and bits of a change's place in its transaction in a running ``_seq``.
STEP, BITS = 1 << 18, 14
#: What of a frame the walk looks at: kind of the frame, and of the message behind the three positions.
HEAD = 26
CHANGES = frozenset(b"IUD")


class Capture:
    """The files of a capture, by names that order them; a path with a scheme is opened by Arrow's file systems."""

    def __init__(self, path: str) -> None:
        self.path, self.fs = path, None
        if "://" in path:
            from pyarrow import fs

            self.fs, self.path = fs.FileSystem.from_uri(path)
        elif path.startswith("file:"):
            self.path = path[len("file:") :]

    def files(self, after: str = "") -> list[str]:
        """Names of the files from one on; the capture's only file has no name."""
        if self.fs is None:
            if not os.path.isdir(self.path):
                return [""] if os.path.exists(self.path) else []
            found = [n for n in os.listdir(self.path) if not n.startswith((".", "_"))]
        else:
            from pyarrow import fs

            if self.fs.get_file_info(self.path).type == fs.FileType.File:
                return [""]
            found = [i.base_name for i in self.fs.get_file_info(fs.FileSelector(self.path, allow_not_found=True)) if not i.base_name.startswith((".", "_"))]
        return sorted(n for n in found if n >= after)

    def _at(self, name: str) -> str:
        return f"{self.path}/{name}" if name else self.path

    def open(self, name: str) -> BinaryIO:
        return open(self._at(name), "rb") if self.fs is None else self.fs.open_input_file(self._at(name))

    def size(self, name: str) -> int:
        return os.path.getsize(self._at(name)) if self.fs is None else self.fs.get_file_info(self._at(name)).size

    def blocks(self, name: str, bits: int) -> dict[int, dict]:
        """The blocks of a file's index by their begins; none where there is no index of the file as it is."""
        try:
            with self.open(_index(name)) as f:
                told = json.loads(f.read())
        except OSError:
            return {}
        return {b["begin"]: b for b in told["blocks"]} if name and (told["size"], told["bits"]) == (self.size(name), bits) else {}

    def add_frames(self, name: str, frames: Iterable[bytes]) -> int:
        """Writes a file of framed frames, with its index, which is there before the file is."""
        index = Index()
        return self.add(name, index.over(frames), lambda: self.add(_index(name), [index.text().encode()]))

    def add(self, name: str, parts: Iterable[bytes], before: Callable[[], object] | None = None) -> int:
        """Writes a file that appears whole; the number of its bytes. An empty one does not appear. ``before`` is done just before it appears."""
        hidden, n = self._at(f"_{uuid.uuid4().hex}"), 0
        if self.fs is None:
            os.makedirs(self.path, exist_ok=True)
        else:
            self.fs.create_dir(self.path, recursive=True)
        with open(hidden, "wb") if self.fs is None else self.fs.open_output_stream(hidden) as f:
            for part in parts:
                f.write(part)
                n += len(part)
            if self.fs is None:
                f.flush()
                os.fsync(f.fileno())
        if n and before is not None:
            before()
        if not n:
            self.remove(os.path.basename(hidden))
        elif self.fs is None:
            os.replace(hidden, self._at(name))
        else:
            self.fs.move(hidden, self._at(name))
        return n

    def remove(self, name: str) -> None:
        for own in (name, _index(name)):
            try:
                os.remove(self._at(own)) if self.fs is None else self.fs.delete_file(self._at(own))
            except FileNotFoundError:
                if own == name:
                    raise


def _index(name: str) -> str:
    return f"_{name}.index"


class Index:
    """What the walk takes in of a file, made as its frames are written.

    A block is either some whole transactions of about ``STEP`` bytes or one larger transaction, with the
    places where it can be cut (byte, changes before it). Through a block ``_seq`` goes from s to the greater of s + ``more`` and
    ``least``. A large transaction that tells a relation after a change has no block, and is walked over.
    """

    def __init__(self) -> None:
        self.blocks: list[dict] = []
        self.at = self.first = self.last_cut = self.changes = 0
        self.cuts: list[tuple[int, int]] = []
        self.told: dict[str, str] = {}
        self.late = False
        self._open()

    def _open(self) -> None:
        self.block = {"begin": self.at, "end": self.at, "n": 0, "more": 0, "least": -(2**62), "commit": 0, "relations": {}}

    def over(self, frames: Iterable[bytes]) -> Iterator[bytes]:
        for f in frames:
            end, kind = self.at + len(f), f[29] if len(f) >= 4 + HEAD and f[4] == 0x77 else 0
            if kind in CHANGES:
                if self.at - self.last_cut >= STEP:
                    self.cuts.append((self.at, self.changes))
                    self.last_cut = self.at
                self.changes += 1
            elif kind == 0x52:
                self.told[str(struct.unpack_from(">I", f, 30)[0])] = f[29:].hex()
                self.late = self.late or self.changes > 0
            self.at = end
            if kind == 0x43:
                self._commit(*struct.unpack_from(">qqq", f, 31))
            yield f

    def _commit(self, commit: int, _: int, moment: int) -> None:
        n, b = self.changes, self.block
        if self.cuts:
            if b["n"]:
                self.blocks.append(b)
            if not self.late:
                self.blocks.append({"begin": self.first, "end": self.at, "n": 1, "commit": commit, "relations": self.told, "changes": n, "moment": moment, "cuts": self.cuts})
            self._open()
        else:
            b |= {"end": self.at, "n": b["n"] + 1, "more": b["more"] + n, "least": max(b["least"], commit << BITS) + n, "commit": commit, "relations": b["relations"] | self.told if self.told else b["relations"]}
            if self.at - b["begin"] >= STEP:
                self.blocks.append(b)
                self._open()
        self.first = self.last_cut = self.at
        self.changes, self.cuts, self.told, self.late = 0, [], {}, False

    def text(self) -> str:
        return json.dumps({"size": self.at, "bits": BITS, "blocks": self.blocks + [self.block] * (self.block["n"] > 0)})


def framed(frame: bytes) -> bytes:
    return struct.pack(">I", len(frame)) + frame


@dataclass(frozen=True)
class Head:
    """A frame as the walk sees it: its place, the place after it, its kind, and the message of the few that are read."""

    at: int
    end: int
    kind: int
    message: bytes | None


def heads(f: BinaryIO, at: int) -> Iterator[Head]:
    """The heads of the frames from a place on; a torn frame at the end is left for later."""
    f.seek(0, os.SEEK_END)
    size = f.tell()
    f.seek(at)
    base, held, seek = at, b"", 0
    while True:
        if at + 4 + HEAD - base > len(held):  # what is held ends in this head
            if at - base > len(held):  # a long frame: its rest is passed over
                f.seek(at)
                held, base = b"", at
            held, base, seek = held[at - base :] + f.read(CHUNK), at, 0
            if len(held) < 4:
                return
        seek = at - base
        (n,) = struct.unpack_from(">I", held, seek)
        end = at + 4 + n
        if end > size:
            return
        kind, message = (held[seek + 29], None) if n >= HEAD and held[seek + 4] == 0x77 else (0, None)
        if kind in b"RC":
            if end - base > len(held):
                f.seek(at)
                held, base, seek = f.read(max(CHUNK, end - at)), at, 0
            message = held[seek + 29 : seek + 4 + n]
        elif kind == 0 and held[seek + 4] not in b"wk":
            raise ValueError(f"unknown frame {held[seek + 4 : seek + 5]!r}")
        yield Head(at, end, kind, message)
        at = end


@dataclass(frozen=True)
class Range(InputPartition):
    """A part of a capture and what its task knows at its begin; ``commit`` (position, microseconds) is that of a part of one transaction."""

    path: str
    file: str
    begin: int
    end: int
    seq: int
    starting: int
    relations: tuple[bytes, ...]
    commit: tuple[int, int] | None = None


@dataclass
class Walk:
    """Cuts a capture into ranges from an offset on.

    An offset is a place between transactions: file, byte, position of the last commit, running ``_seq``, and
    the latest message of each relation, so that whoever reads on needs nothing before it.
    """

    path: str
    starting: int = 0
    size: int = SIZE
    ranges: list[Range] = field(default_factory=list)

    def initial(self) -> dict:
        return {"file": "", "byte": 0, "committed": self.starting, "seq": 0, "relations": {}}

    def total(self) -> int:
        """Bytes of the capture."""
        capture = Capture(self.path)
        return sum(capture.size(name) for name in capture.files())

    def run(self, start: dict, most: int | None = None, upto: dict | None = None, ordinal_bits: int = BITS) -> dict:
        """Adds the ranges between an offset and the last transaction there is, the ``most``-th one, or the offset ``upto``; the offset reached."""
        capture, n = Capture(self.path), 0
        relations = {int(k): bytes.fromhex(v) for k, v in start["relations"].items()}
        reached, seq = dict(start), start["seq"]
        for name in capture.files(start["file"]):
            begin = start["byte"] if name == start["file"] else 0
            if upto is not None and (name, begin) >= (upto["file"], upto["byte"]):
                break
            blocks = capture.blocks(name, ordinal_bits)
            with capture.open(name) as f:
                # What is open: a range of whole transactions (its relations and _seq at the begin), then the
                # transaction that the walk is in: its begin, its changes, and cuts (byte, changes before it, relations).
                known = opened = tuple(relations.values())
                whole = (begin, seq, known)
                first, changes, cuts, last, ended = begin, 0, [], begin, False

                def large(commit: int, moment: int, end: int, base: int) -> None:
                    """Ranges of a transaction of its own."""
                    if first > whole[0]:
                        self._add(name, whole[0], first, whole[1], whole[2])
                    here = whole[2] if first == whole[0] else opened
                    if commit > self.starting:
                        for (a, k, r), b in zip([(first, 0, here), *cuts], [c[0] for c in cuts] + [end]):
                            self.ranges.append(Range(self.path, name, a, b, base + k, self.starting, r, (commit, moment)))

                while not ended:
                    block = blocks.get(last)
                    if block is not None and (most is None or n + block["n"] <= most) and (upto is None or (name, block["end"]) <= (upto["file"], upto["byte"])):
                        if block["relations"]:
                            relations |= {int(k): bytes.fromhex(v) for k, v in block["relations"].items()}
                            known = tuple(relations.values())
                        commit, end, first = block["commit"], block["end"], last
                        if "cuts" in block:
                            cuts, cut, base = [], first, max(seq, commit << ordinal_bits)
                            for at, k in block["cuts"]:
                                if at - cut >= self.size:
                                    cuts.append((at, k, known))
                                    cut = at
                            if cuts:
                                large(commit, block["moment"], end, base)
                            seq = base + block["changes"]
                        else:
                            seq = max(seq + block["more"], block["least"])
                        n, last = n + block["n"], end
                        if cuts or last - whole[0] >= self.size:
                            if not cuts:
                                self._add(name, whole[0], last, whole[1], whole[2])
                            whole = (last, seq, known)
                        first, changes, cuts, opened = last, 0, [], known
                        reached = {"file": name, "byte": last, "committed": commit, "seq": seq, "relations": None}
                        ended = n == most or upto is not None and (name, last) >= (upto["file"], upto["byte"])
                        continue
                    if reached["relations"] is None:
                        reached["relations"] = {str(k): v.hex() for k, v in relations.items()}
                    ended = True  # unless a block begins after one of the next transactions
                    for head in heads(f, last):
                        if head.kind == 0x52:
                            relations[struct.unpack_from(">I", head.message, 1)[0]] = head.message
                            known = None
                        elif head.kind in CHANGES:
                            if head.at - (cuts[-1][0] if cuts else first) >= self.size:
                                known = tuple(relations.values()) if known is None else known
                                cuts.append((head.at, changes, known))
                            changes += 1
                        elif head.kind == 0x43:
                            commit, _, at = struct.unpack_from(">qqq", head.message, 2)
                            base = max(seq, commit << ordinal_bits)
                            if cuts:
                                large(commit, at, head.end, base)
                            seq, last = base + changes, head.end
                            known = tuple(relations.values()) if known is None else known
                            if cuts or last - whole[0] >= self.size:
                                if not cuts:
                                    self._add(name, whole[0], last, whole[1], whole[2])
                                whole = (last, seq, known)
                            first, changes, cuts, opened, n = last, 0, [], known, n + 1
                            reached = {"file": name, "byte": last, "committed": commit, "seq": seq, "relations": {str(k): v.hex() for k, v in relations.items()}}
                            if n == most or upto is not None and (name, last) >= (upto["file"], upto["byte"]):
                                break
                            if last in blocks:
                                ended = False
                                break
                if reached["relations"] is None:
                    reached["relations"] = {str(k): v.hex() for k, v in relations.items()}
                if last > whole[0]:
                    self._add(name, whole[0], last, whole[1], whole[2])
            if n == most:
                break
        return reached

    def _add(self, name: str, begin: int, end: int, seq: int, relations: tuple[bytes, ...]) -> None:
        self.ranges.append(Range(self.path, name, begin, end, seq, self.starting, relations))


def frames_of(part: Range) -> Iterator[bytes]:
    """The frames of a range, read a chunk at a time."""
    with Capture(part.path).open(part.file) as f:
        f.seek(part.begin)
        left, held = part.end - part.begin, b""
        while left > 0 or held:
            more = f.read(min(CHUNK, left)) if left > 0 else b""
            left -= len(more)
            held, at = held + more, 0
            while at + 4 <= len(held):
                n = struct.unpack_from(">I", held, at)[0]
                if at + 4 + n > len(held):
                    break
                yield held[at + 4 : at + 4 + n]
                at += 4 + n
            held = held[at:]
            if not more:
                return


def spooled(poll: Callable[[int], Iterable[bytes]], path: str, after: int) -> int:
    """Puts the frames of the transactions that commit after a position into a file of their own; the position of the last one.

    What comes after the last Commit is left out, for the server sends it again. ``after`` is the last position
    in the folder: files that are there stay as they are, since offsets name places in them.
    """
    capture, reached = Capture(path), after

    def whole() -> Iterator[bytes]:
        nonlocal reached
        held: list[bytes] = []
        for frame in poll(after):
            if frame[:1] != b"w":
                continue
            held.append(framed(frame))
            if frame[25:26] == b"C":
                commit = struct.unpack_from(">q", frame, 27)[0]
                if commit <= after:  # sent again; its relations are told once a session
                    held = [f for f in held if f[29:30] == b"R"]
                    continue
                reached = commit
                yield b"".join(held)
                held = []

    capture.add(f"{after:016x}.frames", whole())
    return reached
