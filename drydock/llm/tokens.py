"""Token ids of whole texts with a public tokenizer.

The tokenizer first cuts a text into pieces that never cross from visible to blank characters, and
codes each piece alone; a single space goes to what follows it. So a text can be coded run by run (from a space after a
visible character up to the next one), and the ids of a run that came before are looked up. Texts with other blanks than space, tab and
line breaks are coded whole. The tokenizer finds its added tokens before it cuts, so a text that holds one is coded whole too.

Runs are told apart by 64-bit hashes, which are sorted arrays beside the places of the ids; a batch of texts is one byte buffer, and its different
runs are looked up together.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from . import common as c

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Runs that one worker remembers, some 60 MB; beyond it the table starts anew, which changes the time only.
REMEMBERED = 2_000_000
#: New runs that are joined to one text, and texts that are coded at a time; the tokenizer takes longer for each character of a long text, and for each call.
JOINED, AT_ONCE = 64, 64
#: Bytes of the longest run that is remembered; longer ones rarely come again.
LONGEST = 200
_VISIBLE = np.ones(256, bool)
_VISIBLE[list(b" \n\r\t")] = False
_ODD_BLANK = re.compile(rb"[\x0b\x0c\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: One of these is in every text that holds an odd blank.
_PERHAPS_ODD = (b"\x0b", b"\x0c", b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")


def tokenizer_path(name: str = TOKENIZER) -> str:
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Coder:
    """Codes texts as little-endian unsigned 32-bit ids, each followed by the end id."""

    _all: dict[tuple[str, int], Coder] = {}

    def __init__(self, name: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.end = end_id
        self.added = sorted(x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values())
        self.widths = self._widths()
        self.used = False
        self._forget()
        c.at_task_end.append(self._task_end)

    @classmethod
    def of(cls, name: str = TOKENIZER, end_id: int = END_ID) -> Coder:
        key = (name, end_id)
        if key not in cls._all:
            cls._all[key] = cls(name, end_id)
        return cls._all[key]

    def _ids(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in done]

    def _widths(self) -> np.ndarray:
        """Bytes of text that each id stands for; byte-level pieces have one character a byte."""
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        out = np.zeros(max(vocab.values()) + 1, np.int64)
        for piece, i in vocab.items():
            out[i] = len(piece)
        return out

    def _forget(self) -> None:
        """``store``: the hashes of runs, sorted; ``slots``: the place of a run's ids in ``pool``, and their number in the low 8 bits."""
        self.store, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pool, self.n = np.full(1, self.end, "<u4"), 1  # the end id has the first place

    def _task_end(self) -> None:
        """The runs stay for the next task that codes texts, not for others."""
        if not self.used and len(self.store):
            self._forget()
        self.used = False

    def _apart(self, raw: bytes, limits: list[int]) -> list[int]:
        """The texts that are coded whole."""
        if not any(x in raw for x in (*_PERHAPS_ODD, *self.added)):
            return []
        texts = (raw[a:b] for a, b in zip(limits[:-1], limits[1:], strict=True))
        return [k for k, text in enumerate(texts) if _ODD_BLANK.search(text) or any(x in text for x in self.added)]

    def _runs(self, buf: np.ndarray, raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(starts, stops, first)``: the runs of all texts, and the number of runs before each text."""
        cut = buf == 32
        cut[1:] &= _VISIBLE[buf[:-1]]
        for k in self._apart(raw, ends.tolist()):
            cut[ends[k] : ends[k + 1]] = False
        cut[ends[:-1][ends[1:] > ends[:-1]]] = True
        starts = np.flatnonzero(cut)
        return starts, np.append(starts[1:], len(buf))[: len(starts)], np.searchsorted(starts, ends)

    def _code_joined(self, raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Codes runs from a space to a visible character, some to a text, and cuts the ids where the runs' bytes end."""
        runs = [raw[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        texts = [b"".join(runs[k : k + JOINED]).decode() for k in range(0, len(runs), JOINED)]
        coded = [x for k in range(0, len(texts), AT_ONCE) for x in self._ids(texts[k : k + AT_ONCE])]
        widths = np.cumsum(self.widths[np.frombuffer(b"".join(coded), "<u4")])
        return coded, np.diff(np.searchsorted(widths, np.cumsum(stops - starts)) + 1, prepend=0)

    def _learn(self, raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes new runs into the pool, behind what is remembered: the place and number of the ids of each."""
        coded, sizes = [], np.zeros(len(starts), np.int64)
        short = stops - starts <= LONGEST
        buf = np.frombuffer(raw, np.uint8)
        joined = short & (buf[starts] == 32) & _VISIBLE[buf[stops - 1]]
        groups = [np.flatnonzero(x) for x in (joined, short & ~joined, ~short)]
        if len(groups[0]):
            coded, sizes[groups[0]] = self._code_joined(raw, starts[groups[0]], stops[groups[0]])
        for group in groups[1:]:
            apart = self._ids([raw[a:b].decode() for a, b in zip(starts[group].tolist(), stops[group].tolist(), strict=True)])
            sizes[group] = [len(x) // 4 for x in apart]
            coded += apart
        order = np.concatenate(groups)
        places = np.empty(len(starts), np.int64)
        places[order] = self.n + np.cumsum(sizes[order]) - sizes[order]
        ids = np.frombuffer(b"".join(coded), "<u4")
        if self.n + len(ids) > len(self.pool):
            pool = np.empty(2 * (self.n + len(ids)), "<u4")
            pool[: self.n] = self.pool[: self.n]
            self.pool = pool
        self.pool[self.n : self.n + len(ids)] = ids
        self.n += int(sizes[short].sum())  # the next ones write over the long ones
        return places, sizes

    def _slots(self, buf: np.ndarray, raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place in the pool, and the number, of the ids of each run."""
        runs, head, of = np.unique(c.span_hashes(buf, starts, stops), return_index=True, return_inverse=True)
        at = np.searchsorted(self.store, runs)
        known = np.zeros(len(runs), bool)
        inside = np.flatnonzero(at < len(self.store))
        known[inside] = self.store[at[inside]] == runs[inside]
        slots = np.empty(len(runs), np.int64)
        slots[known] = self.slots[at[known]]
        places, sizes = slots >> 8, slots & 255
        new = np.flatnonzero(~known)
        if len(new):
            a, b = starts[head[new]], stops[head[new]]
            places[new], sizes[new] = self._learn(raw, a, b)
            new = new[b - a <= LONGEST]
            self.store = np.insert(self.store, at[new], runs[new])
            self.slots = np.insert(self.slots, at[new], places[new] << 8 | sizes[new])
        return places[of], sizes[of]

    def encode(self, texts: list[str | None] | pa.Array, remembered: int = REMEMBERED) -> list[bytes]:
        """The ids of each text with the end id; a null text is empty."""
        self.used = True
        if len(self.store) > remembered:
            self._forget()
        buf, ends = c.text_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        raw, n = buf.tobytes(), len(ends) - 1
        starts, stops, first = self._runs(buf, raw, ends)
        # The runs in order, and after those of each text the end.
        closing = first[1:] + np.arange(n)
        inner = np.ones(len(starts) + n, bool)
        inner[closing] = False
        places, sizes = np.zeros(len(inner), np.int64), np.ones(len(inner), np.int64)
        if len(starts):
            places[inner], sizes[inner] = self._slots(buf, raw, starts, stops)
        before = np.concatenate([[0], np.cumsum(sizes)])
        out = self.pool[np.repeat(places - before[:-1], sizes) + np.arange(before[-1])].tobytes()
        limits = [0, *(4 * before[closing + 1]).tolist()]
        return [out[a:b] for a, b in zip(limits[:-1], limits[1:], strict=True)]
