"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

The field labels a page's leaf blocks, in page order, as article or not. A block's features are the tags it lies
under, the words of their classes, ids and roles, its innermost tags, how much of it is linked, its length, how it
ends, and words that notices and the like are made of. Weights come from pages built by ``html_pages``, whose
labels are known, by gradient steps on the likelihood (forward-backward); the best labelling is found by Viterbi.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from runnel.llm.html_blocks import HEADINGS, Block, blocks
from runnel.llm.html_pages import labelled_pages
from runnel.llm.text_arrays import pieces

#: Bytes of pages that a Python worker holds as text at once.
PIECE = 8 << 20
#: Pages that the field is fitted on, and passes over them.
TRAIN_PAGES, PASSES = 1400, 8

# Fixed value: words of notices, menus, adverts, forms and comment sections.
PHRASES = (
    "cookie cookies copyright subscribe newsletter login privacy terms rights reserved advertisement sponsored comments reply "
    "sitemap share menu search ©".split()
)


def features(block: Block) -> list[str]:
    text, tags = block.text, block.tags
    out = ["bias", *{f"t={t}" for t in tags if t not in ("html", "body")}, *(f"n={n}" for n in block.names)]
    inner = tags[-1] if tags else ""
    out += [f"i={inner}", f"i={'/'.join(tags[-2:])}", "head" if inner in HEADINGS else "not head"]
    share = block.linked / max(1, len(text))
    out.append("linked" if share > 0.8 else "some links" if share > 0.3 else "few links")
    n = text.count(" ") + 1
    out.append("w=1" if n == 1 else "w<4" if n < 4 else "w<10" if n < 10 else "w<30" if n < 30 else "w")
    out.append("ends" if text[-1] in ".!?…\"”" else "open")
    low = text.lower() if n < 30 else ""
    out += [f"p={p}" for p in PHRASES if p in low]
    return out


class Field:
    """Two labels, 0 and 1; only differences of weights matter, so label 0 scores nothing."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.moves = np.zeros((2, 2))
        self.first = 0.0

    def scores(self, page: list[list[str]]) -> list[float]:
        w = self.weights
        return [sum(w.get(f, 0.0) for f in fs) for fs in page]

    def viterbi(self, scores: list[float]) -> list[int]:
        """The best labelling; ties go to 0."""
        if not scores:
            return []
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = 0.0, scores[0] + self.first
        back = []
        for s in scores[1:]:
            from_a, from_b = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = (a + m00 if from_a else b + m10), (a + m01 if from_b else b + m11) + s
        out = [1 if b > a else 0]
        for pair in reversed(back):
            out.append(pair[out[-1]])
        return out[::-1]

    def expect(self, scores: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """Probability of label 1 of each block, and expected numbers of moves, by forward-backward."""
        move = np.exp(self.moves)
        local = [np.array([1.0, np.exp(min(30.0, max(-30.0, s)))]) for s in scores]
        local[0] = local[0] * (1.0, np.exp(self.first))
        forward, backward = [local[0] / local[0].sum()], [np.ones(2)]
        for x in local[1:]:
            v = (forward[-1] @ move) * x
            forward.append(v / v.sum())
        for x in local[:0:-1]:
            v = move @ (x * backward[-1])
            backward.append(v / v.sum())
        backward.reverse()
        p = np.array([f * b for f, b in zip(forward, backward, strict=True)])
        moves = np.zeros((2, 2))
        for i in range(1, len(local)):
            m = forward[i - 1][:, None] * move * (local[i] * backward[i])[None]
            moves += m / m.sum()
        return p[:, 1] / p.sum(axis=1), moves


def train(pages: list[tuple[str, list[bool]]], passes: int = PASSES, rate: float = 0.4, decay: float = 2e-4) -> Field:
    """Adagrad on the likelihood, a page at a time."""
    crf, past = Field(), {}
    past_moves, past_first = np.full((2, 2), 1e-3), 1e-3
    data = [([features(b) for b in blocks(page)], kinds) for page, kinds in pages]
    for _ in range(passes):
        for page, kinds in data:
            if not kinds:
                continue
            p, moves = crf.expect(crf.scores(page))
            grad: dict[str, float] = {}
            for fs, truth, q in zip(page, kinds, p.tolist(), strict=True):
                for f in fs:
                    grad[f] = grad.get(f, 0.0) + truth - q
            for f, g in grad.items():
                old = crf.weights.get(f, 0.0)
                g -= decay * old
                past[f] = past.get(f, 1e-2) + g * g
                crf.weights[f] = old + rate * g / past[f] ** 0.5
            seen = np.zeros((2, 2))
            for a, b in zip(kinds, kinds[1:], strict=False):
                seen[int(a), int(b)] += 1
            g = seen - moves
            past_moves += g * g
            crf.moves += 0.5 * rate * g / np.sqrt(past_moves)
            g = kinds[0] - p[0]
            past_first += g * g
            crf.first += 0.5 * rate * g / past_first**0.5
    return crf


@functools.cache
def field() -> Field:
    """Trained once a process; the pages are the same each time."""
    return train(labelled_pages(TRAIN_PAGES))


def main_text(page: str, crf: Field) -> str:
    found = [b for b in blocks(page) if "head" not in b.tags]
    labels = crf.viterbi(crf.scores([features(b) for b in found]))
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extract(pages: DataFrame, crf: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null or empty html has the empty text, as has a page without an article. Blocks that repeat are all kept.
    Repeated rows are all extracted; an empty table gives no rows; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(crf or field())
    rows = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, PIECE, "html"):
            texts = [main_text(h, shared.value) if h else "" for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op5_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
