"""Token counts with a whole-token shortcut.

Before any text is read, every string of the vocabulary is encoded alone by the tokenizer
itself; those that come out as one token are proved to be whole tokens. A pre-token (the pieces
that merges never cross) found among them counts one, without a merge. Only the rest is given
to the tokenizer. No pre-token crosses white space, so counts are also remembered by word.
"""

from __future__ import annotations

import functools

import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Words a task remembers before it starts anew. Speed only.
WORDS_REMEMBERED = 400_000

# The pieces this tokenizer cuts lower-case text into before merging.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

#: Python splits at these, the tokenizer doesn't take them for white space.
_CONTROLS = regex.compile("[\x1c-\x1f]")
#: Longer words are not worth remembering.
_LONG = 64


def _load(path: str):
    """The tokenizer of a .json file, without truncation and padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def whole_tokens(name: str = VOCABULARY) -> frozenset[str]:
    """ASCII strings of the vocabulary that are one pre-token and encode alone as one token.

    Other letters are left to the tokenizer, which normalises them.
    """
    tokenizer = _load(_path(name))
    strings = sorted({s.removesuffix("</w>") for s in tokenizer.get_vocab()})
    strings = [s for s in strings if s.isascii() and s == s.lower() and PIECES.fullmatch(s)]
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1)


class WordCounts(dict):
    """Number of tokens by word (no white space inside), worked out when first asked for."""

    def __init__(self, tokenizer, whole: frozenset[str]):
        super().__init__()
        self.tokenizer, self.whole = tokenizer, whole

    def _encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> int:
        if word.isascii() and "<|" not in word:
            count = 0
            for piece in PIECES.findall(word.lower()):
                count += 1 if piece in self.whole else self._encoded(piece)
        else:
            # Special strings, and letters that normalising may change, need the whole word.
            count = self._encoded(word)
        if len(word) <= _LONG:
            if len(self) >= WORDS_REMEMBERED:
                self.clear()
            self[word] = count
        return count

    def of(self, text: str) -> int:
        if _CONTROLS.search(text):
            return self._encoded(text)
        return sum(map(self.__getitem__, text.split()))


@functools.lru_cache(maxsize=4)
def _counter(name: str, whole: frozenset[str]) -> WordCounts:
    """One per Python worker, which serves many tasks."""
    return WordCounts(_load(_path(name)), whole)


def token_count(spark: SparkSession, text: Column, name: str = VOCABULARY) -> Column:
    """Tokens of the whole text: no special tokens added, none truncated, a null is empty.

    Special strings inside a text are special tokens, as the tokenizer takes them by default. The
    vocabulary file is read on each executor at ``public_tokenizers.path(name)``; what is sent there
    is the proved strings, bounded by the vocabulary.
    """
    sent = spark.sparkContext.broadcast(whole_tokens(name))

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        counts = _counter(name, sent.value)
        return pa.array([counts.of(t) if t else 0 for t in texts.to_pylist()], pa.int64())

    return run(text)
