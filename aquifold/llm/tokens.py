"""Token ids of many texts with the tokenizers library, repeated words encoded once.

Both vocabularies used here split a text at white space before they merge, so a
text's ids are the ids of its chunks in a row. Arrow splits the texts of a slice
and numbers their distinct chunks; chunks seen before have their ids in a pool of
bounded size, which keeps those that come again, new ones are joined into few calls
of the library, and NumPy gathers the ids of all chunks at once. A text whose white space is not plain single blanks
or line ends goes through the library whole, so the ids are always those of
``encode`` on the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks remembered per worker; beyond that only those that came again stay. Results do not depend on it.
MAX_REMEMBERED = 400_000

#: Characters (UTF-8 bytes) of the texts that are split and looked up together.
SLICE_CHARS = 4_000_000

#: Chunks joined for one call of the library.
_GROUP = 500

_RARE_SPACE = (
    r"[\x01\x02\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_MARK, _REST = "\x01", "\x02"
# Letters that any version of Unicode takes for letters.
_LETTER = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{17f}]"


@lru_cache(maxsize=2)
def corpus_tokenizer(name: str) -> CorpusTokenizer:
    """One encoder per Python worker, so that its chunks serve all tasks the worker runs."""
    return CorpusTokenizer(name)


class _Pool:
    """Ids of remembered chunks, one after the other, with each chunk's place and length."""

    def __init__(self, dtype: np.dtype) -> None:
        self.slots: dict[str, int] = {}
        self._ids, self._used = np.zeros(1 << 16, dtype), 0
        self._starts = np.zeros(1 << 14, np.int64)
        self._lengths = np.zeros(1 << 14, np.int32)
        self._again = np.zeros(1 << 14, bool)

    @staticmethod
    def _roomy(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])

    def find(self, chunks: list[str]) -> np.ndarray:
        """Slots of these chunks, -1 for those not remembered."""
        return np.fromiter(map(self.slots.get, chunks, repeat(-1)), np.int64, len(chunks))

    def add(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Remember these chunks; returns their slots."""
        first, end, used = len(self.slots), len(self.slots) + len(chunks), self._used + len(ids)
        self._ids = self._roomy(self._ids, used)
        self._starts, self._lengths = self._roomy(self._starts, end), self._roomy(self._lengths, end)
        self._again = self._roomy(self._again, end)
        self._ids[self._used : used] = ids
        self._starts[first:end] = self._used + np.cumsum(lengths) - lengths
        self._lengths[first:end] = lengths
        self._used = used
        self.slots.update(zip(chunks, range(first, end), strict=True))
        return np.arange(first, end)

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these chunks in a row, and where each chunk's begin (one more entry at the end)."""
        lengths = self._lengths[slots]
        edges = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        shift = self._starts[slots] - edges[:-1]
        return self._ids[np.repeat(shift, lengths) + np.arange(edges[-1])], edges

    def came_again(self, slots: np.ndarray) -> None:
        self._again[slots] = True

    def shrunk(self, room: int) -> _Pool:
        """A pool of the chunks that came again since they were added, the latest ``room`` of them; they have to come again to stay."""
        kept, out = np.flatnonzero(self._again[: len(self.slots)])[-room:] if room > 0 else np.zeros(0, np.int64), _Pool(self._ids.dtype)
        ids, edges = self.gather(kept)
        chunks = list(self.slots)
        out.add([chunks[i] for i in kept.tolist()], ids, np.diff(edges))
        return out


class CorpusTokenizer:
    """Encodes texts to little-endian unsigned ids of ``dtype``; special tokens' strings are ordinary text."""

    def __init__(self, name: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import public_tokenizers
        from tokenizers import Tokenizer

        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        size = self._library.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")
        bytewise = spec.get("normalizer") is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
        }
        wordwise = not bytewise and spec["model"].get("end_of_word_suffix") == "</w>"
        self._bytewise, self._by_chunk = bytewise, bytewise or wordwise
        self._lowers = "Lowercase" in json.dumps(spec.get("normalizer"))
        self._pool = _Pool(self.dtype)
        self._separator = self.whole("\n" if bytewise else _MARK)
        if len(self._separator) != 1:
            self._by_chunk = False
        # Ids that hold a blank (bytewise: a chunk's first id) or end a word (wordwise: a chunk of letters' last id).
        self._edge = np.zeros(size, bool)
        for token, i in self._library.get_vocab().items():
            self._edge[i] = token.startswith("\u0120") if bytewise else token.endswith("</w>")

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        return self.encode_column(pa.array(texts, pa.large_string()))

    def encode_column(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of every text, null as the empty text; only texts that go through the library whole become Python's."""
        # A slice ends with the text that fills it.
        filled = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_CHARS
        ends = [*(np.flatnonzero(np.diff(filled)) + 1).tolist(), len(column)]
        for start, end in zip([0, *ends[:-1]], ends, strict=True):
            part = column.slice(start, end - start).cast(pa.large_string()).fill_null("")
            plain = self._plain(part) if self._by_chunk else np.zeros(len(part), bool)
            ids, edges = self._by_chunks(part.filter(pa.array(plain)))
            # Arrow keeps the freed arrays of a slice for later ones, far more than a slice needs at once.
            pa.default_memory_pool().release_unused()
            bounds = iter(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
            for i, chunked in enumerate(plain.tolist()):
                if chunked:
                    a, b = next(bounds)
                    yield ids[a:b].tobytes()
                else:
                    yield self.whole(part[i].as_py()).tobytes()

    def _plain(self, column: pa.Array) -> np.ndarray:
        odd = _RARE_SPACE + (r"|  |\n\n| \n|\n " if self._bytewise else "")
        plain = pc.and_(pc.invert(pc.match_substring_regex(column, odd)), pc.not_equal(column, ""))
        return plain.to_numpy(zero_copy_only=False)

    def _by_chunks(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all these texts in a row, and where each text's begin (one more entry at the end)."""
        if not len(column):
            return np.zeros(0, self.dtype), np.zeros(1, np.int64)
        lists = self._chunks(column)
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self._pool.find(chunks)
        new = np.flatnonzero(found < 0)
        self._pool.came_again(found[found >= 0])
        if len(new):
            if len(self._pool.slots) + len(new) > MAX_REMEMBERED:
                self._pool = self._pool.shrunk((MAX_REMEMBERED - len(new)) * 3 // 4)
                found = self._pool.find(chunks)
                new = np.flatnonzero(found < 0)
            missing = [chunks[i] for i in new.tolist()]
            for places, ids, lengths in self._encode_new(missing):
                found[new[places]] = self._pool.add([missing[i] for i in places], ids, lengths)
        slots = found[coded.indices.to_numpy()]
        ids, edges = self._pool.gather(slots)
        return ids, edges[lists.offsets.to_numpy() - lists.offsets[0].as_py()]

    # Bytewise, a chunk that starts with a line end stands for itself, one that starts with a mark for the rest of
    # it (a text's first word, or signs after a letter and what follows them), any other for itself after one blank.
    def _chunks(self, column: pa.Array) -> pa.Array:
        if self._bytewise:
            column = pc.replace_substring(column, "\n", " \n")
            # A run of signs after a letter is a piece of its own; on its own it shares one entry for all words.
            column = pc.replace_substring_regex(column, f"({_LETTER})([.,;:!?#%&*$]+)", rf"\1 {_REST}\2")
            blank = pc.starts_with(column, " ")
            marked = pc.binary_join_element_wise(pa.scalar(_MARK, column.type), column, pa.scalar("", column.type))
            column = pc.if_else(blank, pc.utf8_slice_codeunits(column, 1), marked)
        else:
            column = pc.replace_substring(column, "\n", " ")
            # A run of signs after a letter is a piece of its own; on its own it shares one entry for all words.
            column = pc.replace_substring_regex(column, r"(\pL)([.,;:!?#%&*]+)", r"\1 \2")
            if self._lowers:
                # The library lower-cases in any case; doing it here lets both spellings share an entry.
                column = pc.if_else(pc.string_is_ascii(column), pc.ascii_lower(column), column)
        return pc.split_pattern(column, " ")

    def _encode_new(self, chunks: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Places of chunks in the list, their ids in a row and how many each has, a group at a time."""
        if not self._bytewise:
            letters, others = [], []
            for i, chunk in enumerate(chunks):
                (letters if chunk.isalpha() else others).append(i)
            yield from self._run_on(letters, chunks, "")
            yield from self._joined(others, [chunks[i] for i in others], f" {_MARK} ")
            return
        plain, lines, first = [], [], []
        for i, chunk in enumerate(chunks):
            head = chunk[:1]
            if chunk in ("", "\n"):
                ids = self.whole(chunk or " ")
                yield [i], ids, np.array([len(ids)])
            elif head == "\n":
                lines.append(i)
            elif head == _MARK or head == _REST:
                first.append(i)
            else:
                plain.append(i)
        yield from self._run_on(plain, chunks, " ")
        yield from self._joined(first, [chunks[i][1:] for i in first], "\n")
        for group, ids, lengths in self._joined(lines, [chunks[i][1:] for i in lines], "\n"):
            yield group, np.insert(ids, np.cumsum(lengths) - lengths, self._separator[0]), lengths + 1

    def _run_on(self, places: list[int], chunks: list[str], lead: str) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Ids of the chunks at these places encoded in a row with blanks between, told apart by the ids that begin or end a word."""
        for at in range(0, len(places), _GROUP):
            group = places[at : at + _GROUP]
            part = [chunks[i] for i in group]
            ids = self.whole(lead + " ".join(part))
            edges = np.flatnonzero(self._edge[ids])
            if len(edges) != len(part):
                yield self._singly(group, [lead + c for c in part])
            elif self._bytewise:
                yield group, ids, np.diff(edges, append=len(ids))
            else:
                yield group, ids, np.diff(edges, prepend=-1)

    def _joined(self, places: list[int], items: list[str], separator: str) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Ids of items encoded in a row, told apart by the separator's id."""
        for at in range(0, len(items), _GROUP):
            part, group = items[at : at + _GROUP], places[at : at + _GROUP]
            ids = self.whole(separator.join(part))
            cut = ids == self._separator[0]
            cuts = np.flatnonzero(cut)
            if len(cuts) != len(part) - 1:
                yield self._singly(group, part)
            else:
                yield group, ids[~cut], np.diff(cuts, prepend=-1, append=len(ids)) - 1

    def _singly(self, places: list[int], items: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        each = [self.whole(item) for item in items]
        return places, np.concatenate(each), np.array([len(ids) for ids in each])
