"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tianguis.llm.tokens import TextEncoder, byte_characters, load


class Piece(NamedTuple):
    """A stretch of text: how many tokens, their ids and their strings, both joined by spaces."""

    n: int
    ids: str
    tokens: str


def joined(parts: list[Piece]) -> Piece:
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return Piece(0, "", "")
    counts, ids, tokens = zip(*parts)
    return Piece(sum(counts), " ".join(ids), " ".join(tokens))


class WordBpe:
    """The vocabulary of a tokenizer file and the merging of single words."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.names = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.none = len(pairs)
        self.bytes = byte_characters()
        self.encoder = TextEncoder(path, self.tokenizer, self.of_word, self.of_text, lambda i: self.piece([i]))

    def piece(self, ids: list[int]) -> Piece:
        return Piece(len(ids), " ".join(map(str, ids)), " ".join([self.names[i] for i in ids]))

    def of_word(self, word: str) -> Piece:
        return self.piece(self.merged("".join([self.bytes[b] for b in word.encode()])))

    def of_text(self, text: str) -> Iterator[Piece]:
        """Text in which normalisation needs the tokenizer's own; the words are merged here all the same."""
        normalised = self.tokenizer.normalizer.normalize_str(text)
        for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normalised):
            yield self.piece(self.merged(word))

    def merged(self, word: str) -> list[int]:
        """Ids of a word in byte characters.

        Leaf k of the tree is the rank of the pair that begins at symbol k, as rank * leaves + k, so the smallest key
        is the lowest rank and, of equal ones, the leftmost. The root names the next merge; a merge changes the leaf of
        its own pair, of the pair before and of the symbol taken away, each up to the root.
        """
        merges = self.merges
        ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + self.suffix]]
        n = len(ids)
        if n == 1:
            return ids
        leaves = 1 << (n - 2).bit_length()
        never = self.none * leaves
        tree = [never] * (2 * leaves)
        for k, pair in enumerate(zip(ids, ids[1:])):
            if pair in merges:
                tree[leaves + k] = merges[pair][0] * leaves + k
        for node in range(leaves - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] < never:
            k = tree[1] % leaves
            gone = after[k]
            end = after[k] = after[gone]
            ids[k] = merges[ids[k], ids[gone]][1]
            ids[gone] = -1
            changed = [leaves + gone] if gone < n - 1 else []
            for node in changed:
                tree[node] = never
            if end < n:
                before[end] = k
                pair = (ids[k], ids[end])
                tree[leaves + k] = merges[pair][0] * leaves + k if pair in merges else never
            else:
                tree[leaves + k] = never
            changed.append(leaves + k)
            if (first := before[k]) >= 0:
                pair = (ids[first], ids[k])
                tree[leaves + first] = merges[pair][0] * leaves + first if pair in merges else never
                changed.append(leaves + first)
            for node in changed:
                while node > 1:
                    node >>= 1
                    a, b = tree[2 * node], tree[2 * node + 1]
                    tree[node] = a if a < b else b
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> Piece:
        return joined([p for p in self.encoder.parts(text) if p.n])

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces, which is what a file without a decoder asks for."""
        return " ".join([self.names[i] for i in ids if i in self.names])


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def bpe_round_trip(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (decimal, joined by one space) and decoded text.

    Null text counts as empty and gives no tokens and an empty decoded text. Rows are independent: no shuffle, and a
    worker holds its batch and a bounded number of encoded chunks.
    """

    def encode(texts: pd.Series) -> pd.DataFrame:
        bpe = word_bpe(tokenizer_path)
        return pd.DataFrame([bpe.encode(t) for t in texts], columns=["n_tokens", "ids", "decoded"])

    coded = F.pandas_udf(encode, "n_tokens long, ids string, decoded string")(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), coded.alias("coded")).select("doc_id", "coded.*")


def bpe_digests(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `bpe_round_trip`, with SHA-256 of ids and decoded text in their place, taken where the text is."""

    def encode(texts: pd.Series) -> pd.DataFrame:
        bpe, rows = word_bpe(tokenizer_path), []
        for text in texts:
            n, ids, tokens = bpe.encode(text)
            rows.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(tokens.encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    coded = F.pandas_udf(encode, kind)(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), coded.alias("coded")).select("doc_id", "coded.*")
