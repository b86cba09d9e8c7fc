"""Operator 10: BPE encoding and decoding, exact to the ``tokenizers`` library.

Method: speculate and verify. Greedy longest match proposes the tokens of a word; numpy checks of all
adjacent pairs of a batch's new words decide whether merging could have crossed a boundary; only words
with a failing pair, or with a token that merging cannot reach, are merged exactly.

Why the check suffices: merges happen by rank, leftmost first. Let the first merge across a proposed
boundary happen between tokens a and b. Until then all merges stayed within tokens, and those within
a and b are the ones that the two would make alone. So merging the pair alone would cross its boundary
too. The check walks the merges of a and b backwards, latest first, and looks whether the two symbols
that face each other would have merged earlier.

Scale: one pass, no shuffle. The ids of blank-separated cuts are remembered in a dictionary of bounded
size, by their ids alone; a task holds a batch and that memory.

Defined results: null or empty text has no tokens and decodes to the empty text; very long texts are
encoded whole; of merges of one rank the leftmost comes first; an empty table gives an empty table; rows that repeat come
out as often; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from changeflow.llm.common import Memory, cuts_of, give_back, map_rows, worker_state

#: Entries of each generation of the memories of encoded cuts and words in a Python worker.
REMEMBERED = 150_000
#: Cuts and words of more characters are not remembered, so that the bound on entries is one on memory too.
LONGEST = 64
#: Characters (bytes of UTF-8) that are encoded at once; a longer text stands alone.
AT_ONCE = 1 << 20
NEVER = np.iinfo(np.int64).max


def byte_signs() -> list[str]:
    """The printable sign of each byte in byte-level vocabularies: itself if it is a visible Latin-1 character, else the next one from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    signs, spare = [], 256
    for b in range(256):
        if b in visible:
            signs.append(chr(b))
        else:
            signs.append(chr(spare))
            spare += 1
    return signs


class Codec:
    """A tokenizer file with lower-casing normaliser, regex split and word-end BPE."""

    def __init__(self, file: bytes) -> None:
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = added
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in added.items()}
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if steps != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or spec["decoder"] is not None:
            raise ValueError("this codec reads tokenizer files with NFC, blank and lower-case normalisation, a split by matches and no decoder")
        self.split = regex.compile(split["pattern"]["Regex"])
        self.far = regex.compile("[\\u0530-\\U0010FFFF]")
        # The library is asked for the normal form and the split only, so it gets no vocabulary to hold.
        self.parts = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "post_processor": None, "model": {"type": "BPE", "vocab": {}, "merges": []}}))
        self.signs = byte_signs()
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {(self.vocab[a], self.vocab[b]): (r, self.vocab[a + (b)]) for r, (a, b) in enumerate(pairs)}
        self.rank_of = {p: r for p, (r, _) in self.ranks.items()}.get
        self.made = [t for _, t in self.ranks.values()]
        size = max(self.vocab.values()) + 1
        self.size = size
        self.rank, self.left, self.right = np.full(size, -1), np.full(size, -1), np.full(size, -1)
        twice = False
        for (a, b), (r, t) in self.ranks.items():
            twice |= self.rank[t] >= 0
            self.rank[t], self.left[t], self.right[t] = r, a, b
        made = np.flatnonzero(self.rank >= 0)
        #: Walking merges backwards is right if each token has one merge, later than those of its parts.
        self.orderly = not twice and bool((self.rank[made] > np.maximum(self.rank[self.left[made]], self.rank[self.right[made]])).all())
        keys = np.array([a * size + b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array([r for r, _ in self.ranks.values()], np.int64)[order]
        self.made_by = np.array(self.made, np.int64)
        self.raw = {t: t.to_bytes(4, "little") for t in self.names}
        self.texts = pa.array([self.names.get(t, "") for t in range(max(self.names) + 1)], pa.large_string())
        #: Tokens that merging reaches from their own characters; only these are proposed.
        self.proposed = {t: i for t, i in self.vocab.items() if self.merge(self._symbols(t)) == [i]}
        #: The longest token after each first three signs: longer guesses are not worth a look.
        self.reach: dict[str, int] = {}
        for t in self.proposed:
            n = len(t) - len(self.end) if self.end and t.endswith(self.end) else len(t)
            if n >= 3:
                self.reach[t[:3]] = max(n, self.reach.get(t[:3], 3))
        self.known, self.words = Memory(REMEMBERED), Memory(REMEMBERED)
        self.exact_words = self.checked_words = 0

    def _symbols(self, token: str) -> list[int]:
        chars = list(token)
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            chars = list(token[: -len(self.end)])
            chars[-1] += self.end
        return [self.vocab[c] for c in chars if c in self.vocab]

    def word_symbols(self, word: str) -> list[int]:
        """The first symbols of a word in byte signs; its last one bears the word end."""
        symbols = [*word[:-1], word[-1] + self.end]
        return [self.vocab[c] for c in symbols if c in self.vocab]

    def merge(self, ids: list[int]) -> list[int]:
        """Exact merging by rank, leftmost first."""
        if len(ids) > 48:
            return self._merge_long(ids)
        rank_of, made = self.rank_of, self.made
        ids = list(ids)
        found = [rank_of(p, NEVER) for p in zip(ids, ids[1:])]
        while found:
            low = min(found)
            if low == NEVER:
                break
            k = found.index(low)
            new = ids[k] = made[low]
            del ids[k + 1], found[k]
            if k < len(found):
                found[k] = rank_of((new, ids[k + 1]), NEVER)
            if k:
                found[k - 1] = rank_of((ids[k - 1], new), NEVER)
        return ids

    def merge_all(self, words: list[list[int]]) -> list[list[int]]:
        """``merge`` of many words at once: words of like length are rows of a matrix, and every row takes its lowest pair in each round."""
        out: list[list[int]] = [[]] * len(words)
        by: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by.setdefault((len(w) + 3) // 4 * 4, []).append(k)
        for width, rows in by.items():
            if width > 32 or len(rows) < 64:
                for k in rows:
                    out[k] = self.merge(words[k])
                continue
            ids = np.full((len(rows), width + 1), -1, np.int64)
            for r, k in enumerate(rows):
                ids[r, : len(words[k])] = words[k]
            ranks = self._ranks(ids[:, :-1], ids[:, 1:])
            live = np.arange(len(rows))
            columns = np.arange(width + 1)
            while len(live):
                low = ranks[live].argmin(axis=1)
                best = ranks[live, low]
                go = best < NEVER
                live, low, best = live[go], low[go], best[go]
                if not len(live):
                    break
                # The row moves up behind the pair; its two neighbours have new partners.
                take = np.minimum(columns[None, :] + (columns[None, :] > low[:, None]), width)
                moved = np.take_along_axis(ids[live], take, 1)
                moved[:, -1] = -1
                moved[np.arange(len(live)), low] = self.made_by[best]
                ids[live] = moved
                after = np.take_along_axis(ranks[live], np.minimum(take[:, :-1], width - 1), 1)
                after[:, -1] = NEVER
                at = np.arange(len(live))
                after[at, low] = self._ranks(moved[at, low], moved[at, low + 1])
                before = np.maximum(low - 1, 0)
                after[at, before] = self._ranks(moved[at, before], moved[at, before + 1])
                ranks[live] = after
            sizes = (ids >= 0).sum(1)
            for k, row, n in zip(rows, ids.tolist(), sizes.tolist()):
                out[k] = row[:n]
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids, NEVER where there is no merge."""
        keys = np.where((a < 0) | (b < 0), -1, a * self.size + b)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for words of any length."""
        ids, ranks, n = list(ids), self.ranks, len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(found[0], k, ids[k], ids[k + 1]) for k in range(n - 1) if (found := ranks.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            if not alive[k] or ids[k] != a or (j := after[k]) >= n or ids[j] != b:
                continue
            ids[k], alive[j], after[k] = ranks[a, b][1], False, after[j]
            if after[j] < n:
                before[after[j]] = k
                if found := ranks.get((ids[k], ids[after[j]])):
                    heapq.heappush(heap, (found[0], k, ids[k], ids[after[j]]))
            if (i := before[k]) >= 0 and (found := ranks.get((ids[i], ids[k]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[k]))
        return [t for t, live in zip(ids, alive) if live]

    def propose(self, word: str) -> list[int] | None:
        """Greedy longest match over a word in byte signs, None where nothing matches."""
        proposed, end, reach, n, at, ids = self.proposed, self.end, self.reach, len(word), 0, []
        while at < n:
            to = at + reach.get(word[at : at + 3], 2)
            if to >= n:
                if (t := proposed.get(word[at:] + end)) is not None:
                    ids.append(t)
                    break
                to = n - 1
            while to > at:
                if (t := proposed.get(word[at:to])) is not None:
                    ids.append(t)
                    at = to
                    break
                to -= 1
            else:
                return None
        return ids

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging a's and b's characters together leaves the two tokens, for all pairs at once."""
        good, live = np.ones(len(a), bool), np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), np.full(len(a), NEVER)
        while len(live):
            keys = a * self.size + b
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            crossing = np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)
            bad = crossing < limit
            good[live[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            undo_left = ra > rb
            # At equal ranks the left merge comes first, so a merge across the boundary must rank
            # below one inside a, but may equal one inside b.
            limit = np.where(undo_left, ra, rb + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
            live, a, b, limit = live[go], a[go], b[go], limit[go]
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of words in byte signs: proposals, one check of all adjacent pairs, exact merging of the rest."""
        guesses = [self.propose(w) if self.orderly else None for w in words]
        firsts = np.array([t for g in guesses if g for t in g[:-1]], np.int64)
        seconds = np.array([t for g in guesses if g for t in g[1:]], np.int64)
        if len(firsts):
            keys, back = np.unique(firsts * self.size + seconds, return_inverse=True)
            fine = self.compatible(keys // self.size, keys % self.size)[back].tolist()
        at = 0
        for k, g in enumerate(guesses):
            if g is not None:
                pairs = len(g) - 1
                if pairs and not all(fine[at : at + pairs]):
                    guesses[k] = None
                at += pairs
        failed = [k for k, g in enumerate(guesses) if g is None]
        for k, ids in zip(failed, self.merge_all([self.word_symbols(words[k]) for k in failed])):
            guesses[k] = ids
        self.exact_words += len(failed)
        self.checked_words += len(words)
        return guesses

    def normal_words(self, cut: str) -> list[str]:
        """The split words of a cut without blanks, in byte signs."""
        if cut.isascii():  # letters, or letters and one mark, are most cuts
            if cut.isalpha():
                return [cut.lower()]
            if cut[:-1].isalpha() and cut[-1] in ".,;:!?":
                return [cut[:-1].lower(), cut[-1]]
        if not cut.isascii():
            if self.far.search(cut):  # which of these are letters depends on the Unicode version of the library
                return [w for w, _ in self.parts.pre_tokenizer.pre_tokenize_str(self.parts.normalizer.normalize_str(cut))]
            cut = unicodedata.normalize("NFC", cut).replace("Σ", "σ")  # the library lowers each character alone
        signs = self.signs
        return ["".join([signs[b] for b in w.encode("utf-8", "surrogatepass")]) for w in self.split.findall(cut.lower())]

    def _learn(self, cuts: list[str]) -> None:
        """Puts the ids of the cuts, four bytes each, into the memories."""
        words, known, raw = self.words, self.known.young, self.raw
        split = [self.normal_words(c) for c in cuts]
        young = words.young
        new = list({w for ws in split for w in ws if w not in young and words.recall(w) is None})
        for w, ids in zip(new, self.encode_words(new)):
            young[w] = b"".join([raw[t] for t in ids])
        for c, ws in zip(cuts, split):
            known[c] = young[ws[0]] if len(ws) == 1 else b"".join([young[w] for w in ws])
        for w in new:
            if len(w) > LONGEST:
                del young[w]

    def encode(self, texts: list[str | None] | pa.Array) -> Iterator[tuple[int, bytes, str]]:
        """For each text the number of ids, the ids as little-endian unsigned 32-bit integers, and their decoding."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        special = np.zeros(len(texts), bool)
        for t in self.added:  # written out in a text they are tokens of their own
            special |= np.asarray(pc.fill_null(pc.match_substring(texts, t), False))
        if special.any():
            plain = iter(self.encode_plain(texts.filter(pa.array(~special))))
            for k in range(len(texts)):
                yield self.encode_special(texts[k].as_py()) if special[k] else next(plain)
        else:
            yield from self.encode_plain(texts)

    def encode_special(self, text: str) -> tuple[int, bytes, str]:
        """A text around its special tokens."""
        at, found = 0, []
        for m in self.specials.finditer(text):
            found += [next(self.encode_plain(pa.array([text[at : m.start()]]))), (1, int(self.added[m[0]]).to_bytes(4, "little"), m[0])]
            at = m.end()
        found.append(next(self.encode_plain(pa.array([text[at:]]))))
        return sum(f[0] for f in found), b"".join(f[1] for f in found), " ".join(f[2] for f in found if f[0])

    def encode_plain(self, texts: pa.Array) -> Iterator[tuple[int, bytes, str]]:
        """Texts without special tokens: each different cut is encoded once, and gathered by numpy and Arrow."""
        cuts, order, ends = cuts_of(texts)
        self.known.turn()
        self.words.turn()
        known, recall = self.known.young, self.known.recall
        new = [c for c in cuts if c not in known and recall(c) is None]
        self._learn(new)
        found = [known[c] for c in cuts]
        for c in new:
            if len(c) > LONGEST:
                del known[c]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, begin = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        del cuts, found, new
        n = sizes[order]
        if not n.all():  # a cut of blanks beyond ASCII
            ends, order, n = np.r_[0, np.cumsum(n > 0)][ends], order[n > 0], n[n > 0]
        stop = np.cumsum(n)
        ids = flat[np.repeat(begin[order] - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)]
        bounds = np.r_[0, stop][ends]
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), self.texts.take(pa.array(ids))), pa.scalar(" ", pa.large_string()))
        for k in range(len(texts)):
            a, b = int(bounds[k]), int(bounds[k + 1])
            yield b - a, ids[a:b].tobytes(), joined[k].as_py()

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, joined by blanks, as the library does without a decoder."""
        return " ".join([self.names[t] for t in np.frombuffer(ids, "<u4").tolist()])


def spans(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of texts that are encoded together: at most AT_ONCE in all or a single one, and at most 1024."""
    ends, k = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)), 0
    while k < len(texts):
        upto = int(np.searchsorted(ends, AT_ONCE + (ends[k - 1] if k else 0), "right"))
        n = min(max(upto - k, 1), 1024)
        yield k, n
        k += n


def bpe_encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id, n_tokens, ids binary, decoded string) of every row; with ``digest`` SHA-256 of both instead of themselves.

    ``vocabulary`` is the path of a tokenizer file on the driver. Digests are made where the ids are,
    so that the long forms need not leave a task.
    """
    file = docs.sparkSession.sparkContext.broadcast(open(vocabulary, "rb").read())  # one vocabulary file: its size does not follow the data

    def make():
        codec = worker_state(("bpe", hash(file.value)), lambda: Codec(file.value))

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            ids, texts = batch.column(0), batch.column(1)
            for k, step in spans(texts):
                counts, one, two = [], [], []
                for n, raw, decoded in codec.encode(texts.slice(k, step)):
                    counts.append(n)
                    one.append(sha256(raw).hexdigest() if digest else raw)
                    two.append(sha256(decoded.encode()).hexdigest() if digest else decoded)
                names = ("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded")
                yield {id_col: ids.slice(k, step), "n_tokens": counts, names[0]: one, names[1]: two}
                give_back()

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    rest = "ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded string"
    return map_rows(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, n_tokens long, {rest}")
