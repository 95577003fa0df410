"""Token ids of whole texts by a vocabulary file of the ``tokenizers`` library.

A text is cut only where its tokenizer cuts too. The pieces of a batch are numbered by their
strings, each distinct word is encoded once, and the ids are gathered by number. The ids equal
those of the whole text.
"""

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from advisorbook.llm.common import worker_cache

KEPT_PIECES = 50_000
KEPT_LENGTH = 40
_TWO_SPACES = re.compile(r"^\s|\s\s")
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
# Punctuation that is no part of a contraction or of a special token.
_TAIL = ".,!?;:%$&*#"
_TOGETHER = 1000
_SENTENCE_END = pa.array([".", "!", "?"])


def public_vocabulary(name: str) -> str:
    """The place of a public vocabulary file, where the package with these files is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def batches_of_text(batches: Iterable[pa.RecordBatch], at: int = 1, chars: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some ``chars`` bytes of text, so that what is made of one stays small."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        share = np.cumsum(sizes, dtype=np.int64) // chars
        cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if start < end:
                yield batch.slice(start, end - start)


class Encoder:
    """Ids as little-endian 32-bit integers.

    ``byte_level``: the vocabulary keeps white space, as byte-level BPE does; otherwise it
    drops it. Strings of special tokens inside a text become their ids, the library's default.
    """

    def __init__(self, path: str, byte_level: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.byte_level = Tokenizer.from_file(path), byte_level
        self.tails: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.marks = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, k in vocabulary.items():
            self.marks[k] = token.startswith("Ġ") if byte_level else token.endswith("</w>")

    @classmethod
    def of(cls, path: str, byte_level: bool) -> "Encoder":
        """The worker's own encoder for this file."""
        known = worker_cache("encoders")
        if (path, byte_level) not in known:
            known[path, byte_level] = cls(path, byte_level)
        return known[path, byte_level]

    def _encode(self, pieces: list[str]) -> Iterator[bytes]:
        if self.byte_level:
            pieces = [piece if piece[:1] == "\n" else " " + piece for piece in pieces]
        for start in range(0, len(pieces), 10_000):
            for e in self.library.encode_batch_fast(pieces[start : start + 10_000], add_special_tokens=False):
                yield array("I", e.ids).tobytes()

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and sizes of words of letters, many in one call: the vocabulary marks where a word starts or ends.

        Also which words the tokenizer takes apart, as their normal form holds more than letters.
        """
        ids, sizes, odd = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)], np.zeros(len(words), bool)
        starts = range(0, len(words), _TOGETHER)
        space = " " if self.byte_level else ""
        chunks = [words[k : k + _TOGETHER] for k in starts]
        found = self.library.encode_batch_fast([space + " ".join(c) for c in chunks], add_special_tokens=False)
        for k, chunk, e in zip(starts, chunks, found, strict=True):
            made = np.array(e.ids, "<u4")
            marks = np.flatnonzero(self.marks[made])
            if len(marks) == len(chunk):
                size = np.diff(marks, append=len(made)) if self.byte_level else np.diff(marks, prepend=-1)
            else:
                each = [np.frombuffer(packed, "<u4") for packed in self._encode(chunk)]
                made, size = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
                odd[k : k + len(chunk)] = [self.marks[x].sum() != 1 for x in each]
            ids.append(made)
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes), odd

    def _kept(self, cache: dict[str, bytes], pieces: list[str], encode: Callable) -> list[bytes]:
        """Packed ids of pieces that are no words; those met before come from a bounded cache."""
        if len(cache) > KEPT_PIECES:
            cache.clear()
        new = [piece for piece in dict.fromkeys(pieces) if piece not in cache]
        fresh = dict(zip(new, encode(new), strict=True))
        cache.update((piece, ids) for piece, ids in fresh.items() if len(piece) <= KEPT_LENGTH)
        return [cache[piece] if piece in cache else fresh[piece] for piece in pieces]

    def _bare(self, pieces: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _parts(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A table of ids (values, sizes) and, of each distinct piece, its two entries there.

        A piece of letters and punctuation behind them is a word and a tail, which the
        tokenizer takes apart too; any other piece is one entry. Entry 0 is empty.
        """
        word = pc.utf8_rtrim(pieces, characters=_TAIL)
        plain = pc.utf8_is_alpha(word)
        is_plain = plain.to_numpy(zero_copy_only=False)
        words = word.filter(plain)
        words = (words if self.byte_level else pc.ascii_lower(words)).dictionary_encode()
        ids, word_sizes, odd = self._encode_words(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        is_plain = is_plain.copy()
        first, second = np.zeros(len(pieces), np.int32), np.zeros(len(pieces), np.int32)
        first[is_plain] = words.indices.to_numpy() + 1
        is_plain[is_plain] = ~odd[words.indices.to_numpy()]
        n = len(words.dictionary) + 1
        tailed = np.flatnonzero(is_plain & (pc.binary_length(pieces).to_numpy() > pc.binary_length(word).to_numpy()))
        whole = pieces.take(pa.array(tailed)).to_numpy(zero_copy_only=False).tolist()
        heads = word.take(pa.array(tailed)).to_numpy(zero_copy_only=False).tolist()
        tails = pa.array([p[len(h) :] for p, h in zip(whole, heads, strict=True)], pa.string()).dictionary_encode()
        second[tailed] = tails.indices.to_numpy() + n
        packed = self._kept(self.tails, tails.dictionary.to_pylist(), self._bare)
        others = np.flatnonzero(~is_plain)
        first[others] = n + len(packed) + np.arange(len(others))
        rest = pieces.take(pa.array(others)).to_numpy(zero_copy_only=False).tolist()
        packed += self._kept(self.others, rest, lambda new: list(self._encode(new)))
        sizes = np.concatenate([[0], word_sizes, np.fromiter(map(len, packed), np.int64, len(packed)) // 4])
        return np.concatenate([ids, np.frombuffer(b"".join(packed), "<u4")]), sizes, first, second

    def _gather(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces, where each list and each piece ends among them, and which pieces close a sentence."""
        pieces = lists.flatten().dictionary_encode()
        which = pieces.indices.to_numpy()
        values, sizes, first, second = self._parts(pieces.dictionary)
        entries = np.stack([first[which], second[which]], 1).ravel()
        size = sizes.astype(np.int32)[entries]
        ends = np.cumsum(size, dtype=np.int64)
        shift = ((np.cumsum(sizes) - sizes)[entries] - (ends - size)).astype(np.int32)
        ids = values[np.repeat(shift, size) + np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)]
        ends = ends[1::2]
        last = pc.utf8_slice_codeunits(pieces.dictionary, -1)
        closing = pc.is_in(last, _SENTENCE_END).to_numpy(zero_copy_only=False)[which]
        newline = pc.starts_with(pieces.dictionary, "\n").to_numpy(zero_copy_only=False)[which]
        closing[:-1] |= newline[1:]
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return ids, np.r_[0, ends][at], ends, closing

    def documents(self, texts: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each text its ids with the end id, and the places among them where a sentence or line ends."""
        if not self.byte_level:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            ids, at, ends, closing = self._gather(lists)
            stops = np.unique(ends[closing])
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                first, last = np.searchsorted(stops, (a, b), "right")
                yield np.append(ids[a:b], np.uint32(end_id)), stops[first:last] - a
            return
        whole = [bool(_TWO_SPACES.search(text)) for text in texts.to_pylist()]
        plain = texts if not any(whole) else pc.if_else(pa.array(whole), "", texts)
        plain = pc.binary_join_element_wise("\n", plain, "")  # ids of a text follow that of a newline
        lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ", max_splits=None)
        lists = self._without_first(lists)
        ids, at, ends, closing = self._gather(lists)
        stops = np.unique(ends[closing])
        for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            if whole[k]:
                yield self._uneven(texts[k].as_py(), end_id)
                continue
            first, last = np.searchsorted(stops, (a + 1, b), "right")
            yield np.append(ids[a + 1 : b], np.uint32(end_id)), stops[first:last] - a - 1

    @staticmethod
    def _without_first(lists: pa.ListArray) -> pa.ListArray:
        """Each list without its first member, the empty piece before the first newline."""
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        kept = np.ones(int(offsets[-1]), bool)
        kept[offsets[:-1]] = False
        return pa.ListArray.from_arrays(
            pa.array((offsets - np.arange(len(offsets))).astype(np.int32)), lists.flatten().filter(pa.array(kept))
        )

    def _uneven(self, text: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """A text with runs of white space, cut before single spaces between other characters."""
        first, *rest = _SAFE_CUT.split(text)
        head = np.array(self.library.encode(first, add_special_tokens=False).ids, "<u4")
        words = sorted({piece[1:] for piece in rest})
        known = dict(zip(words, self._kept(self.others, words, lambda new: list(self._encode(new))), strict=True))
        packed = [head.tobytes(), *(known[piece[1:]] for piece in rest)]
        ends = np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed))) // 4
        closing = np.array([piece.rstrip().endswith((".", "!", "?")) for piece in (first, *rest)])
        ids = np.frombuffer(b"".join(packed), "<u4")
        return np.append(ids, np.uint32(end_id)), ends[closing]
