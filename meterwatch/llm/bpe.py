"""BPE encoding and decoding through a table of distinct words.

Texts are split into words in Spark tasks, equal words are counted, and the distinct words
make one table in which each is encoded once. The most frequent words (a fixed number, so
their size is bounded at any size of the corpus) go to the tasks, where every word of a text
is looked up and its ids are put at the word's position. Words beyond them are rare: by
default they are encoded where they stand; with ``rest="joined"`` they too get their ids from
the table, by a join, and travel back to their documents. Decoding looks ids up in the table
of pieces, which is as long as the vocabulary.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import keyed, persist_table
from meterwatch.llm.pretokens import special_pattern, split_special, word_pretokens
from meterwatch.llm.token_count import byte_alphabet, load_tokenizer

#: Words that are sent to every task; about 30 MB in a Python worker.
HEAD_WORDS = 150_000
#: Words beyond them of which a task remembers the ids.
REMEMBERED = 100_000

_LETTER_OF = {b: c for c, b in byte_alphabet().items()}


@lru_cache(maxsize=2)
def _parts(path: str):
    tokenizer = load_tokenizer(path)
    tokens = tokenizer.get_added_tokens_decoder()
    return tokenizer, {t.content: k for k, t in tokens.items()}, special_pattern(list(tokens.values()))


def words_of(text: str, path: str) -> list[str]:
    """The words of a text in order; special strings stay whole."""
    tokenizer, _, special = _parts(path)
    parts = split_special(text, special)
    if len(parts) == 1:
        return word_pretokens(text, tokenizer)
    words: list[str] = []
    for k, part in enumerate(parts):
        words += [part] if k % 2 else word_pretokens(part, tokenizer)
    return words


def word_ids(word: str, path: str) -> list[int]:
    """Ids of one word as ``words_of`` gives it."""
    tokenizer, added, _ = _parts(path)
    if word in added:
        return [added[word]]
    return [t.id for t in tokenizer.model.tokenize("".join(map(_LETTER_OF.__getitem__, word.encode("utf-8", "surrogatepass"))))]


def word_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """word, n: every distinct word of ``keyed`` documents and its number, written down."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 3_000):
                counts: Counter = Counter()
                for text in b["text"].iloc[lo:lo + 3_000]:
                    counts.update(words_of(text, tokenizer_path))
                yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    return persist_table(docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def encoded_words(words: DataFrame, tokenizer_path: str) -> DataFrame:
    """``words`` with the ids of every word."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(ids=[word_ids(w, tokenizer_path) for w in b["word"]])

    return words.mapInPandas(encode, "word string, n long, ids array<int>")


def head_words(words: DataFrame, most: int) -> DataFrame:
    """The most frequent words, ``most`` at the most.

    Cut by classes of frequency: a bounded table of class sizes finds the class
    from which on all words fit.
    """
    level = F.floor(F.log2("n") * 16)
    sizes = sorted(words.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])  # below 1,100 rows
    total, least = 0, None
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        least = r["level"]
    return words.filter(F.lit(False)) if least is None else words.filter(level >= least)


class Head:
    """Head words by number, and their ids in one array; travels as three plain values."""

    def __init__(self, rows: pd.DataFrame):
        self.words = "\n".join(rows["word"])  # a word holds no white space
        self.sizes = np.fromiter(map(len, rows["ids"]), np.int32, len(rows))
        self.flat = np.concatenate([*rows["ids"], np.zeros(0, np.int32)]).astype(np.int32)
        self._numbers = None

    def __getstate__(self):
        return {"words": self.words, "sizes": self.sizes, "flat": self.flat, "_numbers": None}

    @property
    def numbers(self) -> dict[str, int]:
        if self._numbers is None:
            self._numbers = {w: k for k, w in enumerate(self.words.split("\n"))} if len(self.sizes) else {}
            self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64) if len(self.sizes) else np.zeros(0, np.int64)
        return self._numbers

    def place(self, words: list[str], rest) -> np.ndarray:
        """Ids of ``words`` in order; ``rest`` gives those of a word that is not here."""
        get = self.numbers.get
        at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        sizes = np.zeros(len(words), np.int64)
        here = at >= 0
        sizes[here] = self.sizes[at[here]]
        own = [rest(words[k]) for k in missing.tolist()]
        sizes[missing] = [len(i) for i in own]
        ends = np.cumsum(sizes)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        n = sizes[here]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(ends[here] - n, n) + inner] = self.flat[np.repeat(self.starts[at[here]], n) + inner]
        for k, ids in zip(missing.tolist(), own):
            out[ends[k] - len(ids):ends[k]] = ids
        return out


def encode_words(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 most: int = HEAD_WORDS, rest: str = "in place", decoded: bool = False) -> DataFrame:
    """doc_id, text_key, ids (array<int>) for every row of ``docs``; with ``decoded`` also the text that they decode to.

    The ids are those of the library on the whole text without added special
    tokens. NULL, empty and blank texts have no ids; a row with a NULL id is
    encoded like any other; special strings inside a text are one id. Runs jobs
    when called: one table of distinct words is written, ``most`` of them are
    collected.
    """
    docs = keyed(docs, id_col, text_col)
    words = word_table(docs, tokenizer_path)
    head = docs.sparkSession.sparkContext.broadcast(Head(encoded_words(head_words(words, most), tokenizer_path).toPandas()))

    def missing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = head.value.numbers
        for b in batches:
            lists = [[w for w in set(words_of(t, tokenizer_path)) if w not in known] for t in b["text"]]
            yield pd.DataFrame({"text_key": b["text_key"], "word": lists})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, memory = head.value, {}

        def encode(word: str) -> list[int]:
            if word not in memory:
                if len(memory) >= REMEMBERED:
                    memory.clear()
                memory[word] = word_ids(word, tokenizer_path)
            return memory[word]

        for b in batches:
            for lo in range(0, len(b), 500):
                part = b.iloc[lo:lo + 500]
                ids = []
                for text, more in zip(part["text"], part["more"] if rest == "joined" else [None] * len(part)):
                    given = encode if rest != "joined" else {} if more is None else {m["word"]: m["ids"] for m in more}
                    ids.append(table.place(words_of(text, tokenizer_path), given if callable(given) else given.__getitem__))
                out = pd.DataFrame({"doc_id": part["doc_id"], "text_key": part["text_key"], "ids": ids})
                yield out.assign(decoded=_joined(ids, tokenizer_path)) if decoded else out

    schema = "doc_id long, text_key long, ids array<int>" + ", decoded string" * decoded
    if rest != "joined":
        return docs.mapInPandas(place, schema)
    rare = docs.mapInPandas(missing, "text_key long, word array<string>").select("text_key", F.explode("word").alias("word")).distinct()
    rare = rare.join(encoded_words(words, tokenizer_path).select("word", "ids"), "word").groupBy("text_key").agg(
        F.collect_list(F.struct("word", "ids")).alias("more"))
    return docs.join(rare, "text_key", "left").mapInPandas(place, schema)


def decode_ids(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded text; special tokens are written out.

    A file without a decoder, as here, joins pieces by a space; NULL ids decode to
    the empty text. The vocabulary is the only thing that travels.
    """
    names = [c for c in encoded.columns if c != out_col]

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(**{out_col: _joined(b[ids_col], tokenizer_path)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*names).schema.fields)
    return encoded.select(*names).mapInPandas(look_up, f"{schema}, `{out_col}` string")


def _joined(rows, path: str) -> list[str]:
    pieces = _pieces(path)
    return [" ".join(pieces[i].tolist()) if i is not None else "" for i in rows]


@lru_cache(maxsize=2)
def _pieces(path: str) -> np.ndarray:
    tokenizer = load_tokenizer(path)
    pieces = np.full(tokenizer.get_vocab_size(), "", dtype=object)
    for piece, k in tokenizer.get_vocab().items():
        pieces[k] = piece
    return pieces


def bpe_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of ``docs``."""
    both = encode_words(docs, tokenizer_path, decoded=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
