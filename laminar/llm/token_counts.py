"""Token counts under a unigram model, by dynamic programming shared over a trie.

A text is split into pre-tokens; each is segmented into vocabulary pieces of the highest
total score, and the count is the number of pieces (of equally good segmentations, the
shortest counts). The best score of a prefix does not depend on what follows, so the
different pre-tokens go into a byte trie and every node's forward score is computed once,
when the node is made; a pre-token's score and count stand at its terminal node. A node
looks back over the vocabulary pieces that end there: an automaton over the vocabulary
steps along with the trie, and its state names exactly those pieces.

Each worker keeps a trie over its tasks and starts a new one at ``max_nodes``, so memory is
bounded and no text is shuffled. The vocabulary is fixed and read once by each worker.

The scores are a fixed Zipf prior over a public vocabulary's ranks:
``-log(rank + 2) - log(sum over ranks of 1 / (rank + 2))``. Every single byte is a piece,
so every text can be segmented.

Defined results: a NULL or empty text has no pre-tokens, no tokens and score 0. NULL ids
and repeated rows are kept as they come; other columns are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.byte_bpe import read_ranks
from laminar.llm.common import bounded_batches, worker_state

WORDS = 50_000                 # words of a text that are looked up together


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log-probabilities of the pieces under the Zipf prior."""
    total = math.log(math.fsum(1 / (r + 2) for r in ranks.values()))
    return {piece: -math.log(rank + 2) - total for piece, rank in ranks.items()}


class Pieces:
    """The vocabulary pieces that end at a place of a text, by one step per byte: states are beginnings
    of pieces, and ``ending[state]`` holds (length, score) of every piece the state ends with, longest first."""

    def __init__(self, scores: dict[bytes, float]):
        self.step: dict[int, int] = {}              # state * 256 + byte -> state; 0 is the empty beginning
        own: list[tuple] = [()]
        beyond = [(0, 0)]                           # (state before, byte) of a state
        for piece, score in sorted(scores.items(), key=lambda x: len(x[0])):
            state = 0
            for byte in piece:
                edge = state << 8 | byte
                after = self.step.get(edge)
                if after is None:
                    after = self.step[edge] = len(own)
                    own.append(())
                    beyond.append((state, byte))
                state = after
            own[state] = ((len(piece), score),)
        # A state's fallback is its longest proper end that begins a piece. Shorter pieces came first,
        # but their states need not: levels are walked in order of depth.
        depth = [0] * len(own)
        for state in range(1, len(own)):
            depth[state] = depth[beyond[state][0]] + 1
        self.back, self.ending = [0] * len(own), [()] * len(own)
        for state in sorted(range(1, len(own)), key=depth.__getitem__):
            parent, byte = beyond[state]
            if parent:
                self.back[state] = self.after(self.back[parent], byte)
            self.ending[state] = own[state] + self.ending[self.back[state]] if own[state] else self.ending[self.back[state]]

    def after(self, state: int, byte: int) -> int:
        """The longest beginning of a piece that the text ends with after one more byte."""
        while True:
            got = self.step.get(state << 8 | byte)
            if got is not None:
                return got
            if not state:
                return 0
            state = self.back[state]


class Trie:
    """Forward scores of byte strings; node 0 is the empty prefix."""

    def __init__(self, scores: dict[bytes, float]):
        self.pieces = Pieces(scores)
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}             # node * 256 + byte -> node
        self.score, self.count, self.state = [0.0], [0], [0]
        self.terminal: dict[str, int] = {}          # of the words that were looked up as texts

    def __len__(self) -> int:
        return len(self.score)

    def insert(self, word: bytes) -> int:
        """The terminal node of ``word``; nodes that are new get their forward score."""
        child, score, count, state = self.child, self.score, self.count, self.state
        after, ending = self.pieces.after, self.pieces.ending
        path, node = [0], 0
        for byte in word:
            edge = node << 8 | byte
            found = child.get(edge)
            if found is None:
                at = after(state[node], byte)
                best, fewest = -math.inf, 0
                for length, gain in ending[at]:
                    before = path[-length]
                    total, n = score[before] + gain, count[before] + 1
                    if total > best or (total == best and n < fewest):
                        best, fewest = total, n
                found = child[edge] = len(score)
                score.append(best)
                count.append(fewest)
                state.append(at)
            node = found
            path.append(node)
        return node

    def totals(self, words: list[str], max_nodes: int) -> tuple[int, float]:
        """Tokens and score of the words together; the trie starts anew where it is full."""
        n, total = 0, 0.0
        for at in range(0, len(words), WORDS):
            part = words[at:at + WORDS]
            new = set(part).difference(self.terminal)
            if new and len(self) > max_nodes:
                self.clear()
                new = set(part)
            for word in new:
                self.terminal[word] = self.insert(word.encode())
            nodes = list(map(self.terminal.__getitem__, part))
            n += sum(map(self.count.__getitem__, nodes))
            total += sum(map(self.score.__getitem__, nodes))
        return n, total


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 max_nodes: int = 600_000) -> DataFrame:
    """(id, n_pretokens, n_tokens, score) per row; score is the natural log-probability."""
    schema = pa.schema([("id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def run(batches):
        import regex
        split = regex.compile(pattern).findall
        trie = worker_state("trie " + ranks_path, lambda: Trie(zipf_scores(read_ranks(ranks_path))))
        for batch in bounded_batches(batches, 8 << 20):
            sizes, counts, scores = [], [], []
            for text in batch.column(1).to_pylist():
                found = split(text or "")
                n, total = trie.totals(found, max_nodes)
                sizes.append(len(found))
                counts.append(n)
                scores.append(total)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                                              pa.array(scores, pa.float64())], schema=schema)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, n_pretokens bigint, n_tokens bigint, score double")
