"""Token counts by a linear longest-match automaton over a public vocabulary.

The trie of the vocabulary's byte strings has, at each node, a failure link and the
number of tokens that following it pops.  A word (white space before it counts as
one space byte) is walked byte by byte; the pops add up to the number of tokens of
greedy longest-match, and no piece is ever built.  All distinct words of a slice of
rows take their steps together.

A word is a run of ``[^\\x20\\x09-\\x0D]``; white space itself is not counted beyond
the one space in front of a word.  Null and empty texts have zero words and tokens.
The vocabulary is a file of base64 tokens and ranks that has all 256 single bytes;
its path is a parameter, read on the driver and broadcast (a vocabulary is bounded).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textbytes as tb

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_b = np.arange(256)
VISIBLE = ~((_b == 32) | ((_b >= 9) & (_b <= 13)))


@dataclass
class Automaton:
    keys: np.ndarray  # node * 256 + byte, ordered
    child: np.ndarray
    fail: np.ndarray
    pops: np.ndarray
    rest: np.ndarray  # tokens left to pop when a word ends at a node


def read_vocabulary(path: str) -> list[bytes]:
    with open(path, "rb") as file:
        return [base64.b64decode(line.split()[0]) for line in file if line.strip()]


def build(tokens: list[bytes]) -> Automaton:
    trie: list[dict[int, int]] = [{}]
    ends = [False]
    up = [(0, 0)]
    for token in tokens:
        v = 0
        for c in token:
            to = trie[v].get(c)
            if to is None:
                to = trie[v][c] = len(trie)
                trie.append({})
                ends.append(False)
                up.append((v, c))
            v = to
        ends[v] = v > 0
    missing = [c for c in range(256) if c not in trie[0] or not ends[trie[0][c]]]
    if missing:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
    fail, pops = [0] * len(trie), [0] * len(trie)
    level = list(trie[0].values())
    while level:
        below = []
        for v in level:
            if ends[v]:
                pops[v] = 1
            else:
                p, c = up[v]
                z, n = fail[p], pops[p]
                while c not in trie[z]:
                    n += pops[z]
                    z = fail[z]
                fail[v], pops[v] = trie[z][c], n
            below += trie[v].values()
        level = below
    rest = [0] * len(trie)
    for v in range(1, len(trie)):
        u, n = v, 0
        while u:
            n += pops[u]
            u = fail[u]
        rest[v] = n
    keys = np.array([v * 256 + c for v, x in enumerate(trie) for c in x], np.int64)
    child = np.array([to for x in trie for to in x.values()], np.int64)
    order = np.argsort(keys)
    return Automaton(keys[order], child[order], np.array(fail), np.array(pops), np.array(rest))


def lengths(auto: Automaton, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tokens of each word [starts, ends), each with one space in front."""
    space = auto.child[np.searchsorted(auto.keys, 32)]
    state = np.full(len(starts), space)
    count = np.zeros(len(starts), np.int64)
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    live = np.searchsorted(-size[order], -np.arange(1, int(size.max(initial=0)) + 1), side="right")
    for t, n in enumerate(live):
        i = order[:n]
        byte = data[starts[i] + t].astype(np.int64)
        while len(i):
            key = state[i] * 256 + byte
            at = np.minimum(np.searchsorted(auto.keys, key), len(auto.keys) - 1)
            ok = auto.keys[at] == key
            state[i[ok]] = auto.child[at[ok]]
            i, byte = i[~ok], byte[~ok]
            count[i] += auto.pops[state[i]]
            state[i] = auto.fail[state[i]]
    return count + auto.rest[state]


def token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, n_bytes, n_words, n_tokens) of every row."""
    frame, text_of = tb.text_input(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(build(read_vocabulary(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = shared.value
        for batch in batches:
            for a, b, data, offsets in tb.slices(text_of(batch)):
                starts, ends = tb.runs(VISIBLE[data], offsets)
                bounds = np.searchsorted(starts, offsets)
                # Equal words, by 64-bit hash of the unchanged bytes and length, are walked once.
                h = _exact_hashes(data, starts, ends)
                _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
                each = lengths(auto, data, starts[first], ends[first])[inverse] if len(h) else np.zeros(0, np.int64)
                total = np.concatenate([[0], np.cumsum(each)])
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets)), pa.array(np.diff(bounds).astype(np.int64)), pa.array(total[bounds[1:]] - total[bounds[:-1]])],
                    names=["_id", "n_bytes", "n_words", "n_tokens"],
                )

    return frame.mapInArrow(run, f"_id {frame.schema['_id'].dataType.simpleString()}, n_bytes bigint, n_words bigint, n_tokens bigint").withColumnRenamed("_id", id_col)


def _exact_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Like ``textbytes.hashes`` but with upper and lower case apart."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    raw = data[at + np.repeat(starts, size)]
    upper = ((raw >= 65) & (raw <= 90)).astype(np.uint64)
    mark = upper * tb._PLACE[(at * 2 + 1) & 4095]
    return tb.mix64(tb.hashes(data, starts, ends) * np.uint64(3) + np.add.reduceat(mark, first))


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
