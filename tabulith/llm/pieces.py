"""Token counts of a piece vocabulary without making the ids of a text.

No piece of the vocabulary holds a character followed by a space, nor a line break; so a text falls into
pre-tokens (spaces and what follows them up to the next space or line break) that are encoded
independently. Each task keeps a table of piece counts by pre-token, asks the library once for each new
one, joins it to every document's pre-token frequencies and adds up.

A null or empty text has no tokens.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import mul

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from .words import claim_memory

KEPT_PRETOKENS = 500_000  # pre-tokens whose count a worker remembers; beyond, it begins again
COUNT_CHARS = 1_000_000  # characters of text whose new pre-tokens are counted together
SPACE_MARK = "▁"
PRETOKEN = re.compile(r" *[^ \n]+|\n| +")


class PieceCounter:
    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        vocabulary = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        joined = [p for p in vocabulary if re.search(f"[^{SPACE_MARK}]{SPACE_MARK}|.\n|\n.", p)]
        if joined:
            raise ValueError(f"pieces reach over pre-token borders: {joined[:3]}")
        self.counts: dict[str, int] = {}
        self.lead = len(self.model.encode("\n"))  # the space the library puts first, and the line break

    def frequencies(self, text: str | None) -> Counter:
        """Pre-tokens of a text and how often each occurs; the library's leading space is included."""
        return Counter(PRETOKEN.findall(" " + text.replace(SPACE_MARK, " "))) if text else Counter()

    def learn(self, pretokens: Iterable[str]) -> None:
        """Count the pieces of new pre-tokens, each once, behind a line break that keeps the library's space away."""
        words = list(pretokens)
        for w, ids in zip(words, self.model.encode(["\n" + w for w in words], num_threads=1)):
            self.counts[w] = len(ids) - self.lead

    def forget(self) -> None:
        self.counts = {}

    def count_batch(self, texts: Iterable[str | None]) -> Iterator[int]:
        claim_memory(self)
        texts, more = iter(texts), True
        while more:
            rows, size, more = [], 0, False
            for text in texts:
                rows.append(self.frequencies(text))
                size += len(text or "")
                if size > COUNT_CHARS:
                    more = True
                    break
            if len(self.counts) > KEPT_PRETOKENS:
                self.forget()
            self.learn(set(chain.from_iterable(rows)).difference(self.counts))
            for row in rows:
                yield sum(map(mul, map(self.counts.__getitem__, row), row.values()))


@functools.lru_cache(maxsize=2)
def load(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(text: Column, path: str) -> Column:
    """Number of tokens of a text column, bigint."""
    @F.arrow_udf("bigint")
    def counts(texts: pa.Array) -> pa.Array:
        return pa.array(load(path).count_batch(map(pa.StringScalar.as_py, texts)), pa.int64())
    return counts(text)
