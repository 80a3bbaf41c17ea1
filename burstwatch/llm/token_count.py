"""Token counts by heap-and-linked-list byte-pair merging.

The vocabulary file (a sentencepiece BPE model with byte fallback) gives the
ranks. A text is spaces-to-meta-symbol with one meta symbol in front; its
characters are linked symbols, a heap holds the adjacent pairs that form a
piece, and the pair of lowest rank (leftmost among equals) merges until none
is left. The count is the initial symbols less the merges; a character outside
the vocabulary stands for its UTF-8 bytes. No identifiers are made.

No piece spans the step from another character to a meta symbol, nor (checked on
the vocabulary) from letters to other characters, so a text falls apart there
into segments that merge on their own; each worker keeps the counts of short
segments in a bounded table."""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from burstwatch.llm.tasks import arrow_map, record_batch, slices

META = "▁"
#: Segments kept with their counts per worker, and the longest one kept.
MEMO_SEGMENTS = 300_000
MEMO_CHARS = 48
#: Characters of a text that are cut into segments at a time.
PART_CHARS = 1_000_000


class MergeCounter(dict):
    """Counts of segments; looking up an unknown one merges it."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        order = {s: k for k, s in enumerate(sorted({s for _, s in pieces}, reverse=True))}
        self.rank = {p: order[s] for p, s in pieces}
        self.single = {p for p in self.rank if len(p) == 1}
        if any(c != META and n == META for p in self.rank for c, n in zip(p, p[1:])):
            raise ValueError("a piece of this vocabulary spans two words")
        if not {c for p in self.rank for c in p} <= self.single:
            raise ValueError("a piece holds a character that is no piece itself")
        self.cut = re.compile(self._cuts())

    def _cuts(self) -> str:
        """The pattern of segments: runs of letters and digits, and runs of other
        characters, each with the meta symbols before it, if no piece spans such an
        edge (letters that do stand next to others in a piece count as others)."""
        others: set[str] = set()
        for _ in range(2):
            word = {c: c.isalnum() and c not in others for p in self.rank for c in p}
            across = [(c, n) for p in self.rank for c, n in zip(p, p[1:])
                      if META not in (c, n) and word[c] != word[n]]
            if not across:
                odd = "".join(map(re.escape, sorted(others)))
                letter = f"[^\\W_{odd}]"
                return f"{META}*(?:{letter}+|(?:(?!{letter})[^{META}])+)|{META}+"
            others |= {c for pair in across for c in pair if word[c]}
        return f"{META}*[^{META}]+|{META}+"

    def merged(self, segment: str) -> int:
        """Symbols left of one segment: initial symbols less merges."""
        rank, n = self.rank, len(segment)
        weight = n
        if not self.single.issuperset(segment):  # these stand for their UTF-8 bytes
            weight = sum(1 if c in rank else len(c.encode("utf-8")) for c in segment)
        heap = [(rank[p], i, p) for i in range(n - 1) if (p := segment[i:i + 2]) in rank]
        if not heap:
            return weight
        heapify(heap)
        sym: list[str | None] = list(segment)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            _, i, pair = heappop(heap)
            j = after[i]
            if sym[i] is None or j >= n or sym[i] + sym[j] != pair:
                continue  # one side has merged meanwhile
            weight -= 1
            sym[i], sym[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                new = pair + sym[k]
                if new in rank:
                    heappush(heap, (rank[new], i, new))
            h = before[i]
            if h >= 0:
                new = sym[h] + pair
                if new in rank:
                    heappush(heap, (rank[new], h, new))
        return weight

    def __missing__(self, segment: str) -> int:
        count = self.merged(segment)
        if len(segment) <= MEMO_CHARS:
            if len(self) >= MEMO_SEGMENTS:
                self.clear()
            self[segment] = count
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        cut, look = self.cut.findall, self.__getitem__
        text = META + text.replace(" ", META)
        if len(text) <= PART_CHARS:
            return sum(map(look, cut(text)))
        total = at = 0
        while at < len(text):
            to = min(at + PART_CHARS, len(text))
            # a part ends before a meta symbol that follows another character
            while to < len(text) and not (text[to] == META and text[to - 1] != META):
                to += 1
            total += sum(map(look, cut(text[at:to])))
            at = to
        return total


_COUNTERS: dict[str, MergeCounter] = {}


def counter(model_path: str) -> MergeCounter:
    if model_path not in _COUNTERS:
        _COUNTERS[model_path] = MergeCounter(model_path)
    return _COUNTERS[model_path]


def count_kernel(batches, model_path: str, limit: int):
    c = counter(model_path)
    for b in slices(batches, "text"):
        texts = b.column("text").to_pylist()
        n = [c.count(t) for t in texts]
        yield record_batch({"doc_id": b.column("doc_id"),
                            "n_bytes": [len(t.encode("utf-8")) if t else 0 for t in texts],
                            "n_tokens": n, "over_limit": [x > limit for x in n]},
                           n_bytes=pa.int64(), n_tokens=pa.int64())


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    One narrow pass. Null and empty texts have 0 bytes and 0 tokens; null ids and
    repeated rows come back as they are; an empty table gives no rows; very long
    texts are cut into segments part by part."""
    return arrow_map(docs.selectExpr(f"CAST(`{id_col}` AS LONG) AS doc_id", f"CAST(`{text_col}` AS STRING) AS text"),
                     count_kernel, "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
                     model_path, limit)
