"""Token ids of whole texts, computed in Arrow batches with the tokenizers library.

The vocabulary folds case and drops white space, and no merge, normalisation
or special token of it spans white space, so a text's ids are the ids of its
white-space-separated words in order. Each distinct word of a slice is
encoded once by the library and kept in a bounded per-worker cache; the ids
of the texts are then gathered with numpy. A reused worker keeps its encoder for its next tasks.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
# Words in each of the two generations of a worker's cache.
CACHE_WORDS = 250_000
# Texts that go to the library whole: white space that Arrow splits at but the
# vocabulary's \s does not know, what may hold a special token's name, and capitals
# that the vocabulary composes with a mark before it folds their case.
_ODD = r"[\x1c-\x1f]|<\||[A-Z]\pM"
# A letter and a mark are separate pre-tokens for this vocabulary, so a space may come between.
_MARK, _APART = "([a-z])([.,;:!?])", r"\1 \2"
_ASCII_LETTERS = re.compile("[a-z]+").fullmatch


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Table:
    """Ids of words: a word's row in a list column that grows."""

    def __init__(self, end_id: int):
        self.row: dict[str, int] = {}
        self.ids, self.ends = array("i", [end_id]), array("i", [0, 1])  # row 0: the end id

    def add(self, word: str, ids) -> int:
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        row = self.row[word] = len(self.ends) - 2
        return row

    def ids_of(self, row: int):
        return self.ids[self.ends[row] : self.ends[row + 1]]

    def lists(self) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.array(self.ends, np.int32)), pa.array(np.array(self.ids, np.int32)))


class Encoder:
    """Encodes Arrow string columns into (ids, ids per row), the end id appended to each row."""

    def __init__(self, vocabulary: str, end_id: int = END_ID, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(vocabulary)
        self.bytes_as_symbols = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.end, self.limit = end_id, cache_words
        self.young, self.old = _Table(end_id), _Table(end_id)

    def _one_pre_token(self, word: str) -> str | None:
        """The symbols of a word that is letters only, and so one pre-token; None for any other."""
        if _ASCII_LETTERS(word):
            return word
        if not word.isalpha() or not unicodedata.is_normalized("NFC", word):
            return None
        low = "".join(map(str.lower, word))  # letter by letter, as the vocabulary does
        return self.bytes_as_symbols(low)[0][0] if low.isalpha() else None

    def _rows(self, words: list[str]) -> np.ndarray:
        if len(self.young.row) > self.limit:
            self.young, self.old = _Table(self.end), self.young
        young, old, tokenize = self.young, self.old, self.tok.model.tokenize
        rows = np.fromiter((-1 if r is None else r for r in map(young.row.get, words)), np.int64, len(words))
        rest = []
        for at in np.flatnonzero(rows < 0).tolist():
            word = words[at]
            known = old.row.get(word)
            if known is not None:
                rows[at] = young.add(word, old.ids_of(known))
                continue
            symbols = self._one_pre_token(word)
            if symbols is None:
                rest.append(at)
            else:
                rows[at] = young.add(word, [t.id for t in tokenize(symbols)])
        for k in range(0, len(rest), 20_000):
            part = rest[k : k + 20_000]
            for at, e in zip(part, self.tok.encode_batch_fast([words[i] for i in part], add_special_tokens=False), strict=True):
                rows[at] = young.add(words[at], e.ids)
        return rows

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        column = pc.fill_null(column, "") if column.null_count else column
        n = len(column)
        if not n:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        odd = np.flatnonzero(np.asarray(pc.match_substring_regex(column, _ODD)))
        whole = [column[int(i)].as_py() for i in odd]
        if len(odd):
            mask = np.zeros(n, bool)
            mask[odd] = True
            column = pc.if_else(pa.array(mask), "", column)
        split = pc.utf8_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(column), _MARK, _APART))
        coded = split.flatten().dictionary_encode()
        rows = self._rows(np.asarray(coded.dictionary.to_numpy(zero_copy_only=False)).tolist())
        count = np.asarray(pc.list_value_length(split)).astype(np.int64)
        ends = np.cumsum(count)
        # Each text's words, then the row of the end id.
        picks = np.insert(rows[np.asarray(coded.indices)] if len(coded) else np.zeros(0, np.int64), ends, 0)
        taken = self.young.lists().take(pa.array(picks))
        off = np.asarray(taken.offsets).astype(np.int64)
        out = np.asarray(taken.values)[off[0] : off[-1]]
        bounds = off[np.concatenate([[0], ends + np.arange(1, n + 1)])] - off[0]
        if not len(odd):
            return out, np.diff(bounds)
        parts = [out[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i, text in zip(odd, whole, strict=True):
            parts[i] = np.array([*self.tok.encode(text, add_special_tokens=False).ids, self.end], np.int32)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, n)


def worker_encoder(vocabulary: str, end_id: int = END_ID) -> Encoder:
    """This worker's encoder, with the words it has met: a Python worker runs one task after the other.

    It is kept in the library's module, as this one comes anew with every task (pickled by value).
    """
    import tokenizers

    kept = vars(tokenizers).setdefault("_quarry_encoders", {})
    if (vocabulary, end_id) not in kept:
        kept[vocabulary, end_id] = Encoder(vocabulary, end_id)
    return kept[vocabulary, end_id]
