"""Token counts of a unigram model, words of a slice sharing their prefixes in a trie (operator 7).

The distinct pre-tokens of a slice are sorted and put into a trie level by level. For each node, that is once for each
shared prefix, the forward step looks at all pieces that end there: its best score is the best over pieces of the score
at the piece's begin plus the piece's own. The number of pieces on the best way is carried along, and stored for each
pre-token at the node where it ends. Levels are flat arrays; a node keeps the scores of its last ancestors and the
states of a vocabulary trie for all substrings that end at it.

Scores of pieces follow from their ranks by Zipf's law: log(1 / (rank + 3)), normalised. Letters outside the vocabulary
count as many tokens as UTF-8 bytes, at a score well below the worst piece. Equal scores: fewer tokens.

Defined results: null and empty texts have no tokens; pre-tokens longer than ``LEVELS`` letters take the same steps one by
one outside the trie; a very long text is counted whole, in a slice of its own; repeated rows are counted each; columns named
n_pre_tokens or n_tokens are replaced, all others but the text kept; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import slices, table
from countertide.llm.registry import query
from countertide.llm.sentencepiece_bpe import NORMAL, SPACE, default_model, load_model

LEVELS = 40
UNKNOWN_PENALTY = 10.0
_SAME = 1e-9


class Vocabulary:
    """Vocabulary trie as sorted transitions. Small: it travels by broadcast."""

    def __init__(self, pieces: list[tuple[str, float]], cut):
        self.cut = cut
        letters = sorted({c for p, _ in pieces for c in p})
        self.letters = np.array([ord(c) for c in letters], np.int64)
        code = {c: k for k, c in enumerate(letters)}
        moves: dict[tuple[int, int], int] = {}
        scores = [-np.inf]
        for piece, value in pieces:
            state = 0
            for c in piece:
                key = (state, code[c])
                if key not in moves:
                    moves[key] = len(scores)
                    scores.append(-np.inf)
                state = moves[key]
            scores[state] = value
        width = len(letters)
        keys = np.array([s * width + c for s, c in moves], np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], np.array(list(moves.values()), np.int32)[order]
        self.scores, self.width = np.array(scores), width
        self.longest = max(len(p) for p, _ in pieces)
        self.unknown = min(v for _, v in pieces) - UNKNOWN_PENALTY

    def codes(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, -1)

    def move(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        out = np.full(len(states), -1, np.int32)
        alive = np.flatnonzero((states >= 0) & (codes >= 0))
        key = states[alive].astype(np.int64) * self.width + codes[alive]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        out[alive[hit]] = self.targets[at[hit]]
        return out


def zipf_vocabulary(model_path: str) -> Vocabulary:
    """Pieces of a SentencePiece model with log-probabilities by Zipf's law over the order of the file."""
    model = load_model(model_path)
    names = [p for p, k in zip(model.pieces, model.kinds) if k == NORMAL]
    scores = -np.log(np.arange(len(names)) + 3.0)
    scores -= np.log(np.exp(scores).sum())
    return Vocabulary(list(zip(names, scores.tolist())), model.cut)


def _utf8(points: np.ndarray) -> np.ndarray:
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


def trie_counts(words: list[str], vocabulary: Vocabulary) -> np.ndarray:
    """Tokens of each of the sorted distinct words."""
    out = np.zeros(len(words), np.int64)
    lengths = np.array([len(w) for w in words], np.int64)
    long = np.flatnonzero(lengths > LEVELS)
    for k in long:
        out[k] = plain_count(words[k], vocabulary)
    rows = np.flatnonzero((lengths <= LEVELS) & (lengths > 0))
    if not len(rows):
        return out
    points = np.frombuffer("".join([words[k] for k in rows]).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = lengths[rows]
    begin = np.cumsum(size) - size
    codes, n_bytes = vocabulary.codes(points), _utf8(points)
    span = vocabulary.longest
    # The root: score 0 with no tokens, no ancestors, no substrings.
    score = np.full((1, span + 1), -np.inf)
    score[0, 0] = 0.0
    tokens = np.zeros((1, span + 1), np.int64)
    states = np.full((1, span), -1, np.int32)
    node = np.zeros(len(rows), np.int64)
    active = np.arange(len(rows))
    for depth in range(1, int(size.max()) + 1):
        active = active[size[active] >= depth]
        at = begin[active] + depth - 1
        parent, letter = node[active], points[at]
        new = np.concatenate([[True], (parent[1:] != parent[:-1]) | (letter[1:] != letter[:-1])])
        node[active] = np.cumsum(new) - 1
        up, code, many_bytes = parent[new], codes[at[new]], n_bytes[at[new]]
        reach = min(depth, span)
        ahead = np.full((len(up), span), -1, np.int32)
        best, fewest = np.full(len(up), -np.inf), np.zeros(len(up), np.int64)
        for k in range(reach):
            ahead[:, k] = vocabulary.move(np.zeros(len(up), np.int32) if k == 0 else states[up, k - 1], code)
            if k:
                alive = np.flatnonzero(ahead[:, k] >= 0)
            else:
                alive = np.arange(len(up))
            if not len(alive):
                continue
            state = ahead[alive, k]
            own, count = np.where(state >= 0, vocabulary.scores[state], -np.inf), np.ones(len(alive), np.int64)
            if k == 0:  # a letter that is no piece stands for its bytes
                bare = own == -np.inf
                own[bare], count[bare] = vocabulary.unknown, many_bytes[alive][bare]
            value, count = score[up[alive], k] + own, tokens[up[alive], k] + count
            better = (value > best[alive] + _SAME) | ((value > best[alive] - _SAME) & (count < fewest[alive]))
            better &= value > -np.inf
            chosen = alive[better]
            best[chosen], fewest[chosen] = value[better], count[better]
        score = np.column_stack([best, score[up, :-1]])
        tokens = np.column_stack([fewest, tokens[up, :-1]])
        states = ahead
        done = active[size[active] == depth]
        out[rows[done]] = fewest[node[done]]
    return out


def plain_count(word: str, vocabulary: Vocabulary) -> int:
    """The same steps for one word, a letter at a time."""
    points = np.array([ord(c) for c in word], np.int64)
    codes, n_bytes = vocabulary.codes(points).tolist(), _utf8(points).tolist()
    best, count = [0.0], [0]
    live: list[tuple[int, int]] = []
    for at, code in enumerate(codes):
        live.append((at, 0))
        ends = vocabulary.move(np.array([s for _, s in live], np.int32), np.full(len(live), code)).tolist()
        live = [(b, s) for (b, _), s in zip(live, ends) if s >= 0]
        value, tokens = best[at] + vocabulary.unknown, count[at] + n_bytes[at]
        if any(b == at and vocabulary.scores[s] > -np.inf for b, s in live):
            value, tokens = -np.inf, 0
        for b, s in live:
            v, t = best[b] + float(vocabulary.scores[s]), count[b] + 1
            if v > value + _SAME or (v > value - _SAME and v > -np.inf and t < tokens):
                value, tokens = v, t
        best.append(value)
        count.append(tokens)
    return count[-1]


def _counter(shared, kept):
    def run(batches):
        vocabulary = shared.value
        for batch in batches:
            for part in slices(batch, "_text"):
                cut = vocabulary.cut
                words = [cut.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in part.column("_text").to_pylist()]
                distinct = sorted(set().union(*words))
                known = dict(zip(distinct, trie_counts(distinct, vocabulary).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(k) for k in kept],
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([sum([known[x] for x in w]) for w in words], pa.int64()),
                    ],
                    names=[*kept, "n_pre_tokens", "n_tokens"],
                )

    return run


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_pre_tokens`` and ``n_tokens``; nothing is shuffled."""
    kept = [c for c in docs.columns if c not in (text, "n_pre_tokens", "n_tokens")]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_text"))
    schema = source.drop("_text").schema.add("n_pre_tokens", "long").add("n_tokens", "long")
    return source.mapInArrow(_counter(docs.sparkSession.sparkContext.broadcast(vocabulary), kept), schema)


@query("op7_trie_counts")
def op7_trie_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), zipf_vocabulary(default_model()))
