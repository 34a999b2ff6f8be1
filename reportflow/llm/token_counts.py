"""Token counts under a unigram vocabulary by dynamic programming over a shared trie.

A pre-token is a word (a maximal run of characters other than space and 0x09-0x0D) with the space mark before it. The
distinct pre-tokens of some MB of text go into a trie. Every trie node, so every shared prefix, gets its scores once:
the best segmentation's score and number of tokens, and the forward score, the logarithm of the summed probability of
all segmentations. The node where a pre-token ends holds its counts, and texts only add those up. The trie is computed
level by level; pieces under way are followed as states of the vocabulary's own trie, so a level costs the pieces that
are alive, not all lengths.

A character that no piece covers is spelled in bytes. The given vocabulary file is a BPE model whose scores are ranks;
ranks become log-probabilities by Zipf's law, p(r) in proportion to 1 / (r + ``ZIPF_SHIFT``). Unigram models keep theirs.

Defined results: null and empty texts have no pre-tokens and count 0; repeated rows each get a result; an empty table
gives no rows; words of any length are taken whole. Only doc_id and text are read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from reportflow.llm.common import as_strings, bytes_and_offsets, slices
from reportflow.llm.sentencepiece_fst import BPE, DEFAULT_MODEL, MARK, NORMAL, USER, Model, _content

ZIPF_SHIFT = 2.7
TRIE_BYTES = 24 << 20
_LOG10 = float(np.log(10.0))


class Vocabulary:
    """The pieces' trie as sorted (state, character) keys, and a log-probability for every final state."""

    def __init__(self, content: bytes):
        m = Model(content)
        pieces = [(p, s) for p, s, kind in zip(m.pieces, m.scores, m.kinds, strict=True) if kind in (NORMAL, USER)]
        if m.type == BPE:
            order = sorted(range(len(pieces)), key=lambda k: (-pieces[k][1], k))
            weights = np.array([1.0 / (r + ZIPF_SHIFT) for r in range(len(order))])
            logs = np.log(weights / weights.sum())
            pieces = [(pieces[k][0], float(logs[r])) for r, k in enumerate(order)]
        next_state: dict[tuple[int, int], int] = {}
        final: dict[int, float] = {}
        for piece, score in pieces:
            state = 0
            for c in piece:
                state = next_state.setdefault((state, ord(c)), len(next_state) + 1)
            final[state] = score
        keys = np.array([a << 21 | c for a, c in next_state], np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], np.array(list(next_state.values()), np.int64)[order]
        self.score = np.full(len(next_state) + 1, -np.inf)
        self.score[list(final)] = list(final.values())
        self.scores = dict(pieces)
        self.byte_score = min(self.scores.values()) - 2.0

    def follow(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Next states; -1 where no piece goes on."""
        wanted = states << 21 | chars
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.targets[at], -1)


def score_words(words: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Number of tokens and forward score (natural logarithm) of every distinct word, through one trie."""
    n = len(words)
    counts, forward = np.zeros(n, np.int64), np.zeros(n)
    if not n:
        return counts, forward
    order = pc.array_sort_indices(words).to_numpy()
    ordered = words.take(pa.array(order))
    lengths = pc.utf8_length(ordered).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = np.frombuffer("".join(ordered.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)))[:-1]

    # Length of the prefix that each word shares with the one before it: its nodes above that depth exist already.
    shared = np.zeros(n, np.int64)
    alive, depth = np.arange(1, n), 0
    while len(alive):
        alive = alive[(lengths[alive] > depth) & (lengths[alive - 1] > depth)]
        alive = alive[chars[first[alive] + depth] == chars[first[alive - 1] + depth]]
        depth += 1
        shared[alive] = depth

    # The root's level: one node, one state under way.
    level = np.zeros(1, np.int64)
    best, tokens, total = np.zeros(1), np.zeros(1, np.int64), np.zeros(1)
    own, state, from_best, from_tokens, from_total = (np.zeros(1, np.int64), np.zeros(1, np.int64), best, tokens, total)
    longer, depth = np.arange(n), 0
    while True:
        depth += 1
        longer = longer[lengths[longer] >= depth]
        if not len(longer):
            break
        made = longer[shared[longer] < depth]
        parent = np.searchsorted(level, made, side="right") - 1
        char = chars[first[made] + depth - 1]
        # Every state of the parent goes on with the node's character.
        begins = np.searchsorted(own, np.arange(len(level) + 1))
        fan = (begins[1:] - begins[:-1])[parent]
        child = np.repeat(np.arange(len(made)), fan)
        take = np.arange(len(child)) - np.repeat(np.cumsum(fan) - fan, fan) + np.repeat(begins[:-1][parent], fan)
        state = vocabulary.follow(state[take], char[child])
        going = state >= 0
        take, child, state = take[going], child[going], state[going]
        from_best, from_tokens, from_total = from_best[take], from_tokens[take], from_total[take]
        score = vocabulary.score[state]
        ends = np.flatnonzero(score > -np.inf)
        node = child[ends]
        # An uncovered character goes on from the parent, a token for each of its bytes.
        size = 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)
        covered = vocabulary.score[np.maximum(0, vocabulary.follow(np.zeros(len(made), np.int64), char))] > -np.inf
        bare = np.flatnonzero(~covered)
        node = np.concatenate([node, bare])
        one = np.concatenate([from_best[ends] + score[ends], best[parent[bare]] + size[bare] * vocabulary.byte_score])
        many = np.concatenate([from_tokens[ends] + 1, tokens[parent[bare]] + size[bare]])
        summed = np.concatenate([from_total[ends] + score[ends], total[parent[bare]] + size[bare] * vocabulary.byte_score])
        by_node = np.argsort(node, kind="stable")
        node, one, many, summed = node[by_node], one[by_node], many[by_node], summed[by_node]
        at = np.searchsorted(node, np.arange(len(made)))
        best = np.maximum.reduceat(one, at)
        tokens = np.minimum.reduceat(np.where(one == best[node], many, np.iinfo(np.int64).max), at)
        total = np.logaddexp.reduceat(summed, at)
        level = made
        done = longer[lengths[longer] == depth]
        end = np.searchsorted(level, done, side="right") - 1
        counts[order[done]], forward[order[done]] = tokens[end], total[end]
        # Pieces that start behind this node join those under way, kept in the order of the nodes.
        own = np.concatenate([child, np.arange(len(made))])
        keep = np.argsort(own, kind="stable")
        own = own[keep]
        state = np.concatenate([state, np.zeros(len(made), np.int64)])[keep]
        from_best = np.concatenate([from_best, best])[keep]
        from_tokens = np.concatenate([from_tokens, tokens])[keep]
        from_total = np.concatenate([from_total, total])[keep]
    return counts, forward


@lru_cache(maxsize=2)
def vocabulary_of(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def count_texts(strings: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens, tokens and forward score (log10) of every text."""
    lists = pc.ascii_split_whitespace(strings)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary
    counts, forward = np.zeros(len(words), np.int64), np.zeros(len(words))
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    mark, none = (pa.scalar(s, pa.large_string()) for s in (MARK, ""))
    marked = pc.binary_join_element_wise(mark, words.filter(pa.array(real)), none)
    counts[real], forward[real] = score_words(marked, vocabulary)
    of = coded.indices.to_numpy()
    offsets = lists.offsets.to_numpy()
    offsets = offsets - offsets[0]

    def sums(values: np.ndarray) -> np.ndarray:
        running = np.concatenate(([0], np.cumsum(values[of])))
        return running[offsets[1:]] - running[offsets[:-1]]

    return sums(real.astype(np.int64)), sums(counts), sums(forward) / _LOG10


def counted(docs: DataFrame, model_path: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id, n_pretokens, n_tokens (best segmentation) and forward_score (log10) of every row."""
    content = _content(model_path)

    def run(batches):
        vocabulary = vocabulary_of(content)
        for batch in batches:
            strings = as_strings(batch.column("text"))
            _, offsets = bytes_and_offsets(strings)
            parts = [count_texts(strings.slice(a, b - a), vocabulary) for a, b in slices(offsets, TRIE_BYTES)]
            columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t) for k, t in enumerate((np.int64, np.int64, float))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)],
                                             ["doc_id", "n_pretokens", "n_tokens", "forward_score"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_pretokens long, n_tokens long, forward_score double")
