"""Secret scans: base patterns, and a character convolutional network over every candidate.

Base findings follow three patterns and always stay. A candidate is any long run of characters
that keys are written in, of mixed kinds; the network reads it with the text around it and says
how likely it is a secret. It is trained in numpy on labelled findings: pieces that touch a base
finding of any kind are secrets, other candidates are not. At most ``most`` findings of each label
fit the weights and calibrate the scores, those whose windows have the smallest hashes over the
whole corpus. A quarter of all labelled findings is held back; all of these set the threshold: it
finds at least ``recall`` of the held-back secrets, in their own and in other surroundings, with the
fewest false findings, in the middle of the scores for which that holds.

Scanning is one pass without a shuffle. What the driver gets is the bounded sample of windows, and
counts of scores in cells. A candidate that reaches beyond the base findings it touches is read as
well; its finding is added to theirs.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from supplyprep.llm.common import bounded_slices, least_by_hash, map_arrow, materialize, staged, text_or_empty
from supplyprep.llm.quality import at_rank

# The base patterns, and the least length of what each has to match.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16

KINDS = ("assign", "access", "hex", "network")

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_WORDS = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(f"[0-9a-f]{{{HEX_LENGTH},}}")
_RUN = re.compile(r"[A-Za-z0-9+/_=.-]{12,}")
_MIXED = re.compile(r"[0-9]|[a-z].*[A-Z]", re.DOTALL)

SIDE, BODY = 24, 64
WINDOW = SIDE + BODY + SIDE
SPAN = StructType([StructField("kind", StringType(), False), StructField("start", LongType(), False), StructField("end", LongType(), False), StructField("score", DoubleType(), False)])


# --- findings -------------------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base findings in order of start, then kind; ends are exclusive, both in code points."""
    found = []
    if _WORDS.search(text):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    """All runs of key characters of 12 or more that hold a digit or change from small to capital letters."""
    return [m.span() for m in _RUN.finditer(text) if _MIXED.search(m[0])]


def windows(text: str, start: int, end: int) -> list[str]:
    """The candidate with its surroundings, NUL-padded to one length; a long one in several pieces of ``BODY`` characters."""
    out = []
    for at in range(start, end, BODY):
        stop = min(end, at + BODY)
        left, right = text[max(0, at - SIDE) : at], text[stop : stop + SIDE]
        out.append(left.rjust(SIDE, "\0") + text[at:stop].ljust(BODY, "\0") + right.ljust(SIDE, "\0"))
    return out


class Taken:
    """The characters that base findings take, as runs that neither touch nor overlap."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in spans:  # by start
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touches(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.ends) and self.starts[i] < end

    def covers(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.ends) and self.starts[i] <= start and end <= self.ends[i]


# --- network -------------------------------------------------------------------------------


def _codes(texts: list[str]) -> np.ndarray:
    """One number per character: ASCII as it is, 1 for others, 0 for padding."""
    if not texts:
        return np.zeros((0, WINDOW), dtype=np.int64)
    wide = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").reshape(len(texts), WINDOW)
    return np.where(wide < 128, wide, 1).astype(np.int64)


_INSIDE = np.zeros(WINDOW)
_INSIDE[SIDE : SIDE + BODY] = 1.0


@dataclass
class Network:
    """Embedding, one convolution of width 5, largest and mean response, logistic output."""

    embed: np.ndarray  # 128 x e
    kernel: np.ndarray  # 5 (e + 1) x f
    bias: np.ndarray  # f
    out: np.ndarray  # 2 f + 1
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0  # above 1: nothing is added

    @staticmethod
    def fresh(seed: int, e: int = 8, f: int = 24) -> Network:
        rng = np.random.default_rng(seed)
        return Network(rng.normal(0, 0.5, (128, e)), rng.normal(0, (5 * (e + 1)) ** -0.5, (5 * (e + 1), f)), np.zeros(f), rng.normal(0, 0.1, 2 * f + 1))

    def _forward(self, codes: np.ndarray) -> tuple:
        n = len(codes)
        seen = np.concatenate([self.embed[codes], np.broadcast_to(_INSIDE[None, :, None], (n, WINDOW, 1))], axis=2)
        patches = np.lib.stride_tricks.sliding_window_view(seen, 5, axis=1).transpose(0, 1, 3, 2).reshape(n, WINDOW - 4, -1)
        raw = patches @ self.kernel + self.bias
        act = np.maximum(raw, 0)
        where = act.argmax(axis=1)
        top = np.take_along_axis(act, where[:, None, :], axis=1)[:, 0]
        pooled = np.concatenate([top, act.mean(axis=1), np.ones((n, 1))], axis=1)
        return patches, raw, where, pooled, pooled @ self.out

    def logits(self, texts: list[str]) -> np.ndarray:
        codes = _codes(texts)
        return np.concatenate([self._forward(codes[i : i + 256])[-1] for i in range(0, len(codes), 256)] or [np.zeros(0)])

    def scores(self, texts: list[str]) -> np.ndarray:
        """Calibrated probabilities."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(texts) + self.shift, -30, 30)))

    def fit(self, texts: list[str], labels: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.01, seed: int = 1) -> Network:
        codes, labels, rng = _codes(texts), labels.astype(float), np.random.default_rng(seed)
        weight = np.where(labels > 0, len(labels) / max(1.0, 2 * labels.sum()), len(labels) / max(1.0, 2 * (1 - labels).sum()))
        params = [self.embed, self.kernel, self.bias, self.out]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        f = len(self.bias)
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                patches, raw, where, pooled, logit = self._forward(codes[pick])
                error = weight[pick] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[pick]) / len(pick)
                back = error[:, None] * self.out[None, :]
                grad = np.repeat(back[:, None, f : 2 * f] / (WINDOW - 4), WINDOW - 4, axis=1)
                np.put_along_axis(grad, where[:, None, :], np.take_along_axis(grad, where[:, None, :], axis=1) + back[:, None, :f], axis=1)
                grad *= raw > 0
                flat = grad.reshape(-1, f)
                deep = (grad @ self.kernel.T).reshape(len(pick), WINDOW - 4, 5, -1)[..., :-1]
                embed = np.zeros_like(self.embed)
                for k in range(5):
                    np.add.at(embed, codes[pick][:, k : k + WINDOW - 4], deep[:, :, k])
                step += 1
                for p, g, m, v in zip(params, [embed, patches.reshape(-1, patches.shape[2]).T @ flat, flat.sum(axis=0), pooled.T @ error], first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def calibrate(self, texts: list[str], labels: np.ndarray) -> Network:
        """Fit slope and shift on held-back findings by Newton steps."""
        x = self.logits(texts)
        design = np.stack([x, np.ones_like(x)], axis=1)
        theta = np.array([1.0, 0.0])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
            hess = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
            theta -= np.linalg.solve(hess, design.T @ (p - labels) + 0.01 * (theta - [1.0, 0.0]))
        self.slope, self.shift = float(max(theta[0], 1e-3)), float(theta[1])
        return self


# --- tables -------------------------------------------------------------------------------


def labelled_windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """(window, label) of every piece of every candidate of every text; it is a secret if it touches a base finding."""
    source = docs.select(text_or_empty(docs[text]).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches):
            found, labels = [], []
            for t in batch.column(0).to_pylist():
                runs = candidates(t)
                taken = Taken(base_spans(t) if runs else [])
                for start, end in runs:
                    found += windows(t, start, end)
                    labels += [int(taken.touches(at, min(end, at + BODY))) for at in range(start, end, BODY)]
            if found:
                yield pa.RecordBatch.from_pydict({"window": found, "label": pa.array(labels, pa.int32())})

    return map_arrow(source, run, "window string, label int")


def moved(secret: str, other: str) -> str:
    """The window of a secret in the surroundings of another one, so that the key itself counts, too."""
    return other[:SIDE] + secret[SIDE : SIDE + BODY] + other[SIDE + BODY :]


def train(docs: DataFrame, text: str = "text", most: int = 3000, recall: float = 0.98, seed: int = 7) -> Network:
    """A network trained on at most ``most`` distinct labelled findings of each label; its threshold is of all that are held back.

    Without findings of both labels in both parts the network adds nothing.
    """
    found, n = materialize(labelled_windows(docs, text).groupBy("window").agg(F.max("label").alias("label")), "labelled-windows", F.col("label") == 1)
    mark, held = F.xxhash64("window"), (F.pmod(F.xxhash64("window", F.lit(1)), F.lit(4)) == 0).alias("held")
    of = {1: n, 0: found.count() - n}
    rows = [r for label in (0, 1) for r in least_by_hash(found.where(F.col("label") == label).select("*", held), mark, of[label], most)]
    labels, part, texts = np.array([r["label"] for r in rows]), np.array([r["held"] for r in rows], dtype=bool), [r["window"] for r in rows]
    network = Network.fresh(seed)
    if not all(((labels == k) & (part == h)).any() for k in (0, 1) for h in (False, True)):
        return network

    def shown(chosen: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Findings of one part; each secret a second time in the surroundings of another candidate."""
        secrets = [t for t, p, k in zip(texts, chosen, labels, strict=True) if p and k]
        others = [t for t, p, k in zip(texts, chosen, labels, strict=True) if p and not k]
        again = [moved(t, o) for t, o in zip(secrets, others * (len(secrets) // len(others) + 1), strict=False)]
        return secrets + again + others, np.array([1] * (len(secrets) + len(again)) + [0] * len(others))

    network.fit(*shown(~part)).calibrate(*shown(part))
    others = [t for t, p, k in zip(texts, part, labels, strict=True) if p and not k]
    logits = staged(held_logits(found.where(held), network, others), "held-logits")
    hits = logits.where("label = 1").select("logit")
    least, _ = at_rank(hits, "logit", int(np.floor((1 - recall) * hits.count())))
    # Any threshold between the others below and that secret finds as much and no more: take the middle.
    below = logits.where((F.col("label") == 0) & (F.col("logit") < least)).agg(F.max("logit")).first()[0]
    cut = least if below is None else (least + below) / 2
    network.threshold = float(1 / (1 + np.exp(-np.clip(cut, -30, 30))))
    return network


def held_logits(held: DataFrame, network: Network, others: list[str]) -> DataFrame:
    """(label, logit) of every held-back window; a secret also in the surroundings of one of ``others``, which its hash chooses."""
    source = held.select("window", "label", F.pmod(F.xxhash64("window", F.lit(2)), F.lit(len(others))).cast("int").alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels, other = (c.to_pylist() for c in batch.columns)
            again = [moved(t, others[o]) for t, k, o in zip(texts, labels, other, strict=True) if k]
            logits = network.slope * network.logits(texts + again) + network.shift
            yield pa.RecordBatch.from_arrays([pa.array(labels + [1] * len(again), pa.int32()), pa.array(logits)], names=["label", "logit"])

    return map_arrow(source, run, "label int, logit double")


def spans_of(texts: list[str], network: Network) -> list[list[tuple[str, int, int, float]]]:
    """All spans of each text: the base ones, score 1, and the candidates that reach beyond them and that the network takes."""
    base = [base_spans(t) for t in texts]
    tried, pieces = [], []
    for i, t in enumerate(texts):
        taken = Taken(base[i])
        for start, end in candidates(t):
            if not taken.covers(start, end):
                for piece in windows(t, start, end):
                    tried.append((i, start, end))
                    pieces.append(piece)
    best: dict[tuple[int, int, int], float] = {}
    for place, score in zip(tried, network.scores(pieces).tolist(), strict=True):
        best[place] = max(best.get(place, 0.0), score)
    found = [[(*s, 1.0) for s in spans] for spans in base]
    for (i, start, end), score in best.items():
        if score >= network.threshold:
            found[i].append(("network", start, end, score))
    return [sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))) for spans in found]


def scan(docs: DataFrame, network: Network, text: str = "text", spans: str = "spans", redacted: str | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``spans``: kind, start, end and score of every finding.

    With ``redacted`` a column of that name holds the text with each finding replaced by its kind
    in brackets; it may be ``text`` itself. Null texts have no findings and stay null; every row
    stays. Columns of ``docs`` with the names of new ones are replaced.
    """
    added = [spans] + ([redacted] if redacted and redacted != text else [])
    source = docs.drop(*added)
    names, place = source.columns, source.columns.index(text)
    schema = StructType([*source.schema.fields, StructField(spans, ArrayType(SPAN, False), False)])
    if redacted and redacted != text:
        schema = schema.add(redacted, StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, text):
            values = batch.column(place).to_pylist()
            found = spans_of([v or "" for v in values], network)
            columns = list(batch.columns)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            lists = pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in row] for row in found], kind)
            clean = pa.array([v if v is None else mask(v, row) for v, row in zip(values, found, strict=True)], batch.column(place).type) if redacted else None
            if redacted == text:
                columns[place] = clean
            yield pa.RecordBatch.from_arrays([*columns, lists] + ([clean] if len(added) == 2 else []), names=[*names, *added])

    return map_arrow(source, run, schema)


def mask(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with findings replaced by their kind; overlapping ones become one, named after the first."""
    out, at, ends = [], 0, -1
    for kind, start, end, _ in spans:
        if start >= ends:
            out += [text[at:start], f"[{kind}]"]
        ends = at = max(at, end)
    return "".join(out) + text[at:]


def scan_digest(scanned: DataFrame, spans: str = "spans") -> DataFrame:
    """Per document: counts of base findings, a digest of them, and all spans as kind:start:end."""
    shown = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.filter(spans, lambda s: s["kind"] != "network")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id",
        *[count(k) for k in KINDS[:3]],
        F.sha2(F.array_join(F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(shown, ",").alias("spans"),
    )
