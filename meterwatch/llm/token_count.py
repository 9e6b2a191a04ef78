"""Token counts without running merges on whole tokens.

Offline, every vocabulary string is encoded alone; those that come back as the one token
that they are get a place in the table of whole tokens. A text is split into pre-tokens, its
different pre-tokens are counted, and those in the table count one each. Only the rest is
merged, each different pre-token once per task while it is remembered.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import keyed
from meterwatch.llm.pretokens import byte_pretokens, special_pattern, split_special

#: Pre-tokens whose merges a task remembers.
REMEMBERED = 300_000


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_alphabet() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))})
    return letters


def whole_tokens(tokenizer) -> set[str]:
    """Vocabulary strings that, encoded alone, give just their own id."""
    letters = byte_alphabet()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    strings, ids = [], []
    for piece, number in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            text = bytes(letters[c] for c in piece).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character: no pre-token can be this string
        if text not in special:
            strings.append(text)
            ids.append(number)
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    return {s for s, n, e in zip(strings, ids, encoded) if e.ids == [n]}


class TokenCounter:
    """Counts tokens of texts with one tokenizer file."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.whole = whole_tokens(self.tokenizer)
        self.special = special_pattern(list(self.tokenizer.get_added_tokens_decoder().values()))
        self.merged: dict[str, int] = {}

    def rest(self, pretoken: str) -> int:
        """Tokens of a pre-token that is not a whole token."""
        if pretoken not in self.merged:
            if len(self.merged) >= REMEMBERED:
                self.merged.clear()
            self.merged[pretoken] = len(self.tokenizer.model.tokenize(self.as_pieces(pretoken)))
        return self.merged[pretoken]

    def as_pieces(self, pretoken: str) -> str:
        return "".join(map(_LETTER_OF.__getitem__, pretoken.encode("utf-8")))

    def __call__(self, text: str) -> int:
        total = 0
        for k, part in enumerate(split_special(text, self.special)):
            if k % 2:
                total += 1
            elif part:
                counts = Counter(byte_pretokens(part, self.tokenizer))
                whole = counts.keys() & self.whole
                total += sum(map(counts.__getitem__, whole))
                for pretoken in counts.keys() - whole:
                    total += counts[pretoken] * self.rest(pretoken)
        return total


_LETTER_OF = {b: c for c, b in byte_alphabet().items()}


@lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``.

    Counts are those of the library on the whole text without added begin or end
    tokens; special strings inside a text are one token each, as is the library's
    default. NULL and empty texts have 0 bytes and 0 tokens; NULL ids and repeated
    rows are counted like any other. No shuffle.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(tokenizer_path)
        for b in batches:
            n = [counter(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": b["n_bytes"], "n_tokens": pd.Series(n, dtype="int64"),
                                "over_limit": pd.Series([x > limit for x in n], dtype="bool")})

    rows = keyed(docs, id_col, text_col).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.mapInPandas(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
