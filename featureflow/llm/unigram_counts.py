"""Token counts under a unigram model, by dynamic programming over a trie.

The model gives every piece of a vocabulary a log probability; a pre-token is
cut into the pieces of the largest sum. The best sum of a prefix does not depend
on what follows, so the different pre-tokens are inserted in a trie and the
forward score is computed once per node, that is, once per shared prefix. The
node at which a pre-token ends stores its count; a text's count is the sum over
its pre-tokens.

Work is row by row in Arrow batches, without a shuffle. A trie has a bounded
number of nodes and starts afresh when full, which changes the time, never the
result; pre-tokens longer than ``LONGEST`` bytes are scored by the same
recurrence without nodes.

The vocabulary is read on the driver and broadcast: its size is that of its
file. No tokenizer is trained: a piece's probability follows from its rank by
Zipf's law unless scores are given.

Defined cases: null text is read as empty and has no tokens; equal sums go to
fewer pieces; a byte that no piece covers counts as one token at the lowest
score less ten; an empty table gives an empty table; any id passes through;
repeated rows are counted one by one; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm.byte_bpe import PLANE, compile_pattern, load_ranks
from featureflow.llm.common import workers_import

NODES = 800_000
LONGEST = 64


def zipf_scores(ranks: dict[bytes, int], shift: float = 100.0) -> dict[bytes, float]:
    """Log probabilities in proportion to 1 / (rank + shift)."""
    total = sum(1.0 / (r + shift) for r in ranks.values())
    return {p: -math.log((r + shift) * total) for p, r in ranks.items()}


class UnigramTrie:
    def __init__(self, scores: dict[bytes, float], nodes: int = NODES):
        self.scores, self.most = scores, nodes
        self.unknown = min(scores.values(), default=0.0) - 10.0
        # scores of pieces; None for an ending of a piece that is none itself. What is absent ends no longer piece either.
        self.endings: dict[bytes, float | None] = dict.fromkeys(p[i:] for p in scores for i in range(1, len(p)))
        self.endings.update(scores)
        self._clear()

    def _clear(self) -> None:
        self.child: dict[int, int] = {}  # node * 256 + byte -> node
        self.best: list[tuple[float, int]] = [(0.0, 0)]  # forward score, negative tokens
        self.ends: dict[str, tuple[float, int]] = {}  # what the node holds at which a pre-token ends

    def _forward(self, piece: bytes, depth: int, best: list[tuple[float, int]]) -> tuple[float, int]:
        """The best (score, -tokens) of piece[:depth]; best[d] is that of piece[:d]."""
        look, top, count = self.endings.get, -math.inf, 0
        for start in range(depth - 1, -1, -1):
            s = look(piece[start:depth], 1.0)
            if s is None:
                continue
            if s > 0:
                break
            before, tokens = best[start]
            before += s
            if before > top or (before == top and tokens - 1 > count):
                top, count = before, tokens - 1
        if top == -math.inf:
            return best[depth - 1][0] + self.unknown, best[depth - 1][1] - 1
        return top, count

    def add(self, pre_token: str) -> tuple[float, int]:
        """(score, -tokens) of a pre-token, inserted if it is new."""
        known = self.ends.get(pre_token)
        if known is not None:
            return known
        piece = pre_token.encode("utf-8", "surrogatepass")
        if len(piece) > LONGEST:
            done = [(0.0, 0)]
            for depth in range(1, len(piece) + 1):
                done.append(self._forward(piece, depth, done))
            return done[-1]
        if len(self.best) > self.most:
            self._clear()
        child, best = self.child, self.best
        node, path = 0, [best[0]]
        for depth, byte in enumerate(piece, 1):
            key = node * 256 + byte
            node = child.get(key)
            if node is None:
                node = child[key] = len(best)
                best.append(self._forward(piece, depth, path))
            path.append(best[node])
        found = self.ends[pre_token] = path[-1]
        return found


def pre_tokens(pattern: str):
    """``findall`` of the pattern; texts without code points beyond the first plane take classes without them, as in ``byte_bpe``."""
    anywhere, plain = compile_pattern(pattern).findall, compile_pattern(pattern, PLANE).findall
    beyond = re.compile(f"[{chr(PLANE)}-{chr(0x10FFFF)}]").search
    return lambda text: anywhere(text) if beyond(text) else plain(text)


_TRIES: dict[str, tuple] = {}


def _ready(shared):
    key, scores, pattern = shared.value
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = (UnigramTrie(scores), pre_tokens(pattern))
    return _TRIES[key]


def share_model(spark: SparkSession, path: str, pattern: str):
    workers_import(spark)
    return spark.sparkContext.broadcast((uuid.uuid4().hex, zipf_scores(load_ranks(path)), pattern))


def token_counts(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pre_tokens, n_tokens, log_prob), one row per input row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, find = _ready(model)
        for b in batches:
            pre, n, logs = [], [], []
            for t in b.column(1):
                pieces = find(t.as_py())
                known, add = trie.ends.get, trie.add
                found = [known(p) or add(p) for p in pieces]
                pre.append(len(pieces))
                scores, tokens = zip(*found) if found else ((), ())
                n.append(-sum(tokens))
                logs.append(math.fsum(scores))
            yield pa.record_batch([b.column(0), pa.array(pre, pa.int64()), pa.array(n, pa.int64()), pa.array(logs, pa.float64())],
                                  names=["id", "n_pre_tokens", "n_tokens", "log_prob"])

    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return src.mapInArrow(run, f"id {id_type}, n_pre_tokens long, n_tokens long, log_prob double").withColumnRenamed("id", id_col)
