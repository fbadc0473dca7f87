"""Token counts by a linear longest-match automaton.

Greedy word pieces: at each place of a word the longest vocabulary entry is taken. Instead of
building pieces, a trie of the vocabulary carries two things per node, computed once: a failure
link, the node where matching goes on after the pieces that a failed match ends have been popped,
and how many pieces those are. Each symbol of a word is then read once; the count is the sum of
popped pieces. A word that the vocabulary can't spell counts as one unknown token.

Words are lower-cased runs of letters, single digits, or runs of other visible characters, as the
vocabulary's own pre-tokenizer has it; a word's symbols are its UTF-8 bytes, and an entry may stand
anywhere in a word. Counting runs per distinct word of a task. Null and blank texts have no tokens; repeated rows are counted alike.
"""

from __future__ import annotations

import json
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import chunks

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: The pre-tokenizer's pattern.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Distinct words whose counts a task remembers before it starts afresh.
REMEMBERED = 1 << 20


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The distinct entries as bytes, the mark of word ends taken off."""
    with open(path, encoding="utf-8") as f:
        entries = json.load(f)["model"]["vocab"]
    letters = byte_letters()
    bodies = {entry.removesuffix("</w>") for entry in entries}
    return sorted(bytes(letters[c] for c in b) for b in bodies if b and all(c in letters for c in b))


@dataclass
class Automaton:
    """``step[node * 256 + byte]``: child. ``link``: failure link, -1 none. ``popped``: pieces ended."""

    step: dict[int, int]
    link: list[int]
    popped: list[int]

    def count(self, word: bytes) -> int:
        """Greedy pieces of a word; 1 if it can't be spelt, 0 for an empty one."""
        step, link, popped = self.step, self.link, self.popped
        node = pieces = 0
        for symbol in word:
            while (child := step.get(node * 256 + symbol)) is None:
                if (up := link[node]) < 0:
                    return 1
                pieces += popped[node]
                node = up
            node = child
        while node:
            if (up := link[node]) < 0:
                return 1
            pieces += popped[node]
            node = up
        return pieces


def build(vocabulary: list[bytes]) -> Automaton:
    """Trie, and by breadth first the failure links with the pieces that following them pops."""
    step: dict[int, int] = {}
    children: list[list[tuple[int, int]]] = [[]]
    whole = [False]
    for entry in vocabulary:
        node = 0
        for symbol in entry:
            child = step.get(node * 256 + symbol)
            if child is None:
                child = step[node * 256 + symbol] = len(children)
                children[node].append((symbol, child))
                children.append([])
                whole.append(False)
            node = child
        whole[node] = node != 0
    link, popped = [-1] * len(children), [0] * len(children)
    queue = deque([0])
    while queue:
        parent = queue.popleft()
        for symbol, node in children[parent]:
            queue.append(node)
            if whole[node]:
                link[node], popped[node] = 0, 1
                continue
            up, pieces = link[parent], popped[parent]
            while up >= 0 and (found := step.get(up * 256 + symbol)) is None:
                pieces += popped[up]
                up = link[up]
            if up >= 0:
                link[node], popped[node] = found, pieces
    return Automaton(step, link, popped)


def count_tokens(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every text. The vocabulary, of fixed size, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(build(read_vocabulary(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = shared.value, {}
        for batch in chunks(batches, "text"):
            n_words, n_tokens = [], []
            for text in batch.column("text").to_pylist():
                found = Counter(PATTERN.findall(text.lower())) if text else {}
                total = 0
                for word, n in found.items():
                    pieces = known.get(word)
                    if pieces is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        pieces = known[word] = automaton.count(word.encode("utf-8", "replace"))
                    total += n * pieces
                n_words.append(sum(found.values()))
                n_tokens.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
