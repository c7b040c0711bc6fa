"""Token ids of whole text columns by a word-level BPE vocabulary file, each word encoded once.

The ids equal those of the tokenizers library on every text. White space ends a word in this
vocabulary, so a text may be cut there, and between a letter and ASCII punctuation; each distinct
piece is encoded once per worker process and then looked up by hash for whole blocks. Texts that
hold a special token's string or combining marks, where cuts or lower case could show, go to the
library as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import ClassVar

import numpy as np
import pyarrow as pa

from curbflow.llm import textbytes as tb
from curbflow.llm.idtable import IdTable

_IN_WORD = tb.byte_table(lambda b: b not in b" \t\n\r")
_ASCII_LETTER = tb.byte_table(lambda b: chr(b).isalpha() and b < 128)
_PUNCTUATION = tb.byte_table(lambda b: 33 <= b < 127 and not chr(b).isalnum())
_LATIN_TAIL = tb.byte_table(lambda b: 0x80 <= b < 0xC0 and b not in (0x97, 0xB7))  # after 0xC3: a letter
_MARKS = (0xCC, 0xCD)  # lead bytes of U+0300 to U+037F


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    _shared: ClassVar[dict[str, "WordBpe"]] = {}

    @classmethod
    def shared(cls, path: str) -> "WordBpe":
        """One per worker process and file, until ``forget``."""
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    @classmethod
    def forget(cls) -> None:
        cls._shared.clear()

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.table = IdTable()

    def encode(self, column: pa.Array, end_id: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of every row, in order; ``end_id`` is added to each."""
        data, offsets = tb.utf8(column)
        extra = [] if end_id is None else [end_id]
        for first, last in tb.blocks(offsets):
            part = data[offsets[first] : offsets[last]]
            ids, ends = self._block(part, offsets[first : last + 1] - offsets[first])
            odd = self._odd(part, offsets[first : last + 1] - offsets[first])
            begin = 0
            for row in range(last - first):
                if odd is not None and odd[row]:
                    text = bytes(part[offsets[first + row] - offsets[first] : offsets[first + row + 1] - offsets[first]])
                    own = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
                    yield first + row, np.array([*own, *extra], np.uint32)
                else:
                    own = ids[begin : ends[row]]
                    yield first + row, np.append(own, np.array(extra, np.uint32))
                begin = ends[row]

    def _odd(self, part: np.ndarray, offsets: np.ndarray) -> np.ndarray | None:
        """Rows that the library must see whole."""
        hits = list(np.flatnonzero(np.isin(part, _MARKS)))
        raw = part.tobytes()
        for special in self.specials:
            at = raw.find(special)
            while at >= 0:
                hits.append(at)
                at = raw.find(special, at + 1)
        if not hits:
            return None
        odd = np.zeros(len(offsets) - 1, bool)
        odd[np.searchsorted(offsets, np.array(hits), side="right") - 1] = True
        return odd

    def _block(self, part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block, and where each document's ids end; long documents go in steps."""
        out, ends, begin = [], np.zeros(len(offsets) - 1, np.int64), 0
        for a, b in tb.steps(part, offsets, _IN_WORD):
            low = tb.LOWER[part[a:b]]
            ids, word_ends, starts = self._step(low, tb.within(offsets, a, b))
            # documents that end in this step
            done = np.flatnonzero((offsets[1:] > a) & (offsets[1:] <= b))
            upto = np.searchsorted(starts, offsets[1:][done] - a)
            ends[done] = begin + np.concatenate([[0], word_ends])[upto]
            out.append(ids)
            begin += len(ids)
        return np.concatenate(out) if out else np.zeros(0, np.uint32), np.maximum.accumulate(ends)

    def _step(self, low: np.ndarray, borders: np.ndarray):
        letter = _ASCII_LETTER[low]
        if len(low) > 1:
            letter[1:] |= (low[:-1] == 0xC3) & _LATIN_TAIL[low[1:]]
        cuts = np.zeros(len(low), bool)  # between a letter and punctuation
        cuts[1:] = letter[:-1] & _PUNCTUATION[low[1:]]
        starts, ends = tb.runs(_IN_WORD[low], borders, cuts)
        hashes = tb.span_hash(tb.prefix_sums(low), starts, ends) | np.uint64(1)
        if self.table.full():
            self.table.reset()
        found = self.table.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            raw = low.tobytes()
            self.table.learn(new, self._ids([raw[starts[i] : ends[i]] for i in missing[first]]))
            found[missing] = self.table.find(hashes[missing])
        ids, word_ends = self.table.ids(found)
        return ids, word_ends, starts

    def _ids(self, words: list[bytes]) -> list[list[int]]:
        """Lower-case words of letters go to the model at once, all others through the library."""
        out: list[list[int]] = [[]] * len(words)
        rest: list[int] = []
        model, letters = self.tokenizer.model, self.letters
        for i, word in enumerate(words):
            text = word.decode("utf-8", "replace")
            if text.isascii() and text.isalpha() or not text.isascii() and text.isalpha() and text.islower() and max(text) <= "ÿ":
                out[i] = [t.id for t in model.tokenize(text if text.isascii() else "".join(letters[b] for b in word))]
            else:
                rest.append(i)
        for i, code in zip(rest, self.tokenizer.encode_batch_fast([words[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False)):
            out[i] = code.ids
        return out
