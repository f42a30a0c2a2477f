"""Secrets: patterns, and a character network over every candidate and its surroundings.

The patterns find assignments of secrets, access keys and long hexadecimal strings. A
candidate is any run of twelve or more key characters. The network reads windows of a candidate
with the characters around it: character embeddings, one convolution, the maximum and the
mean over all places, one logistic unit; all in numpy.

Windows are labelled by the patterns (one that a pattern span overlaps is a finding). Each
is learned as it stands, with its surroundings masked, and so in upper case and shorter: the
network should know a secret without the name before it, in either case and of any length,
for those are what the patterns miss. All distinct windows take part: half of them are
learned, a quarter, in these forms, calibrates the scores and sets the threshold, the highest at
which ``recall`` of its findings are met; another quarter, masked, measures recall and false alarms.

The network starts from a bounded sample on the driver. All windows to learn are then dealt to
shards by their draws, each shard learns from all of its own, and the mean is the network. Shards
depend on the windows alone, and means are of whole numbers, so the files' layout does not matter.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import arrow_schema, map_rows
from tallyhouse.llm.spans import Span, digest, written
from tallyhouse.session import write_through

KINDS = ("assign", "access", "hex", "network")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")

# A window: part of a candidate with this much around it. Longer candidates have several.
AROUND, INSIDE = 12, 40
WIDTH = INSIDE + 2 * AROUND
_EMBED, _FILTERS, _SPAN = 8, 24, 5
_CHARS = 98  # none, other, the printable ASCII characters
_LEAST_STEPS = 400
# Windows of a shard, on average; scores are counted in steps of a logit, parameters in parts of one.
_SHARD, _STEPS, _PARTS = 8192, 256, 1 << 24

Place = tuple[int, int]


def base_spans(text: str | None) -> list[Span]:
    if not text:
        return []
    found: list[Span] = []
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def pieces(start: int, end: int) -> list[Place]:
    """Places of a candidate's pieces, ``INSIDE`` characters each, the last one shorter."""
    return [(place, min(place + INSIDE, end)) for place in range(start, end, INSIDE)]


def overlaps(place: Place, spans: list[Span]) -> bool:
    return any(start < place[1] and place[0] < end for start, _, end in spans)


def windows(text: str, start: int, end: int) -> list[str]:
    """The pieces of a candidate, each with its surroundings, padded with NUL."""
    out = []
    for place, stop in pieces(start, end):
        left = text[max(0, place - AROUND) : place].rjust(AROUND, "\0")
        out.append((left + text[place:stop].ljust(INSIDE, "\0") + text[stop : stop + AROUND]).ljust(WIDTH, "\0"))
    return out


def encode(windows: list[str]) -> np.ndarray:
    """Numbers of the characters, (windows x WIDTH)."""
    codes = np.frombuffer("".join(windows).encode("utf-32-le"), np.uint32).reshape(-1, WIDTH)
    return np.where(codes == 0, 0, np.where((codes >= 32) & (codes < 127), codes - 30, 1)).astype(np.int64)


def masked(codes: np.ndarray) -> np.ndarray:
    """The same windows without what stands around the candidate."""
    bare = codes.copy()
    bare[:, :AROUND] = bare[:, AROUND + INSIDE :] = 0
    return bare


def raised(codes: np.ndarray) -> np.ndarray:
    """The same windows with a-z in upper case."""
    first, last = encode(["az".ljust(WIDTH, "\0")])[0, :2]
    return np.where((codes >= first) & (codes <= last), codes - 32, codes)


def mixed(codes: np.ndarray) -> np.ndarray:
    """Whether the candidate's piece has both letters and digits."""
    inside = codes[:, AROUND : AROUND + INSIDE]
    zero, nine, upper_a, upper_z, a, z = encode(["09AZaz".ljust(WIDTH, "\0")])[0, :6]
    letters = (inside >= upper_a) & (inside <= upper_z) | (inside >= a) & (inside <= z)
    return letters.any(axis=1) & ((inside >= zero) & (inside <= nine)).any(axis=1)


def shortened(codes: np.ndarray) -> np.ndarray:
    """The same windows with the first half of the candidate's piece, 12 characters at least."""
    inside = (codes[:, AROUND : AROUND + INSIDE] > 0).sum(axis=1)
    ends = AROUND + np.maximum(inside // 2, 12)
    return np.where((np.arange(WIDTH) < ends[:, None]) | (np.arange(WIDTH) >= AROUND + INSIDE), codes, 0)


def forms(codes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows as they stand, masked, in upper case, and shorter, with their labels."""
    bare = masked(codes)
    made = [codes, bare, raised(bare), shortened(bare), raised(shortened(bare))]
    return np.concatenate(made), np.tile(labels, len(made))


class Network:
    """Embedding, convolution, pooling and a logistic unit; ``a`` and ``b`` calibrate it.

    ``recall`` and ``alarms`` are measured at ``threshold`` on windows that were neither learned nor
    calibrated on, null where there are none. ``used`` says whether the scores may add spans.
    """

    _NAMES = ("embed", "filters", "bias", "out", "shift")

    def __init__(self, seed: int = 3) -> None:
        draws = np.random.default_rng(seed)
        self.embed = draws.normal(0, 0.3, (_CHARS, _EMBED)).astype(np.float32)
        # Whether a place belongs to the candidate is one more input.
        self.filters = draws.normal(0, 0.2, (_SPAN * (_EMBED + 1), _FILTERS)).astype(np.float32)
        self.bias = np.zeros(_FILTERS, np.float32)
        self.out = draws.normal(0, 0.2, 2 * _FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)
        self.a, self.b, self.threshold = 1.0, 0.0, 1.1
        self.recall: float | None = None
        self.alarms: float | None = None
        self.used = False

    def _forward(self, codes: np.ndarray) -> tuple:
        n = len(codes)
        mark = np.zeros((n, WIDTH, 1), np.float32)
        mark[:, AROUND : AROUND + INSIDE] = 1
        x = np.concatenate([self.embed[codes], mark], axis=2)
        rows = np.lib.stride_tricks.sliding_window_view(x, _SPAN, axis=1).transpose(0, 1, 3, 2)
        rows = rows.reshape(n * (WIDTH - _SPAN + 1), -1)
        raw = (rows @ self.filters + self.bias).reshape(n, -1, _FILTERS)
        lit = np.maximum(raw, 0)
        top = lit.argmax(axis=1)
        pooled = np.concatenate([lit.max(axis=1), lit.mean(axis=1)], axis=1)
        return rows, lit, top, pooled, pooled @ self.out + self.shift[0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        """Uncalibrated scores in whole steps, a bounded number of windows at a time."""
        exact = np.concatenate([self._forward(codes[i : i + 512])[4] for i in range(0, len(codes), 512)] or [np.empty(0)])
        return np.floor(exact.astype(np.float64) * _STEPS) / _STEPS

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return self._calibrated(self.logits(codes))

    def _calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * logits + self.b, -60, 60)))

    def parameters(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self._NAMES])

    def with_parameters(self, values: np.ndarray) -> Network:
        """A network, not calibrated, with these in the order of :meth:`parameters`."""
        made, place = Network(), 0
        for name in self._NAMES:
            old = getattr(made, name)
            setattr(made, name, values[place : place + old.size].reshape(old.shape).astype(np.float32))
            place += old.size
        return made

    def train(
        self, codes: np.ndarray, labels: np.ndarray, rounds: int = 8, size: int = 64, seed: int = 5,
        steps: int = _LEAST_STEPS, rate: float = 3e-3,
    ) -> None:
        """At least that many rounds and steps of Adam; findings and others weigh the same in all."""
        first = {k: np.zeros_like(getattr(self, k)) for k in self._NAMES}
        second = {k: np.zeros_like(getattr(self, k)) for k in self._NAMES}
        draws, step = np.random.default_rng(seed), 0
        weight = np.where(labels == 1, len(labels) / 2 / max(1, labels.sum()), len(labels) / 2 / max(1, (1 - labels).sum()))
        for _ in range(max(rounds, -(-steps * size // len(codes)))):
            order = draws.permutation(len(codes))
            for start in range(0, len(order), size):
                chosen = order[start : start + size]
                step += 1
                for name, slope in self._slopes(codes[chosen], labels[chosen], weight[chosen]).items():
                    first[name] = 0.9 * first[name] + 0.1 * slope
                    second[name] = 0.999 * second[name] + 0.001 * slope**2
                    pace = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    setattr(self, name, (getattr(self, name) - pace * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32))

    def _slopes(self, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        rows, lit, top, pooled, logit = self._forward(codes)
        n, places = lit.shape[:2]
        error = ((1 / (1 + np.exp(-np.clip(logit, -60, 60))) - labels) * weight / n).astype(np.float32)
        of_pooled = error[:, None] * self.out
        of_lit = np.repeat(of_pooled[:, None, _FILTERS:] / places, places, axis=1)
        i, k = np.ogrid[:n, :_FILTERS]
        of_lit[i, top, k] += of_pooled[:, :_FILTERS]
        of_raw = (of_lit * (lit > 0)).reshape(n * places, _FILTERS)
        of_rows = (of_raw @ self.filters.T).reshape(n, places, _SPAN, _EMBED + 1)
        of_x = np.zeros((n, WIDTH, _EMBED), np.float32)
        for j in range(_SPAN):
            of_x[:, j : j + places] += of_rows[:, :, j, :_EMBED]
        of_embed = np.zeros_like(self.embed)
        np.add.at(of_embed, codes, of_x)
        return {"embed": of_embed, "filters": rows.T @ of_raw, "bias": of_raw.sum(axis=0),
                "out": pooled.T @ error, "shift": error.sum(keepdims=True)}

    def calibrate(self, codes: np.ndarray, labels: np.ndarray, recall: float) -> None:
        """Platt scaling, then the highest threshold that meets ``recall`` of the findings."""
        self.calibrate_counted(self.logits(codes), labels, np.ones(len(labels), np.int64), recall)

    def calibrate_counted(self, logit: np.ndarray, labels: np.ndarray, counts: np.ndarray, recall: float) -> None:
        """:meth:`calibrate` for scores that are met ``counts`` times each."""
        a, b, total = 1.0, 0.0, counts.sum()
        for _ in range(300):
            p = 1 / (1 + np.exp(-np.clip(a * logit + b, -60, 60)))
            a -= 0.1 * float(((p - labels) * logit * counts).sum() / total) / max(1.0, float((logit**2 * counts).sum() / total))
            b -= 0.1 * float(((p - labels) * counts).sum() / total)
        self.a, self.b = max(a, 1e-3), b
        order = np.argsort(logit[labels == 1], kind="stable")
        met = np.cumsum(counts[labels == 1][order])
        if len(met):
            lowest = logit[labels == 1][order][np.searchsorted(met, int((1 - recall) * met[-1]), "right")]
            # Half a step lower, so that rounding cannot part a score from an equal one.
            self.threshold = float(self._calibrated(np.array([lowest - 0.5 / _STEPS]))[0])

    def measure(self, codes: np.ndarray, labels: np.ndarray, alarms: float) -> None:
        """Recall and share of false alarms at the threshold; over ``alarms`` the network is not used."""
        self.measure_counted(self.logits(codes), labels, np.ones(len(labels), np.int64), alarms)

    def measure_counted(self, logit: np.ndarray, labels: np.ndarray, counts: np.ndarray, alarms: float) -> None:
        """:meth:`measure` for scores that are met ``counts`` times each."""
        fired = (self._calibrated(logit) >= self.threshold) * counts
        of = [int(counts[labels == label].sum()) for label in (0, 1)]
        self.recall = float(fired[labels == 1].sum() / of[1]) if of[1] else None
        self.alarms = float(fired[labels == 0].sum() / of[0]) if of[0] else None
        self.used = self.alarms is not None and self.alarms <= alarms


_FOUND = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, starts array<long>, "
    "kinds array<long>, ends array<long>, c_starts array<long>, c_ends array<long>, c_labels array<long>"
)


def find_base(documents: DataFrame) -> DataFrame:
    """Per row: pattern spans, every candidate's place, label and windows, and the labels of those."""
    schema = arrow_schema(_FOUND).append(pa.field("c_windows", pa.list_(pa.list_(pa.string()))))
    schema = schema.append(pa.field("w_labels", pa.list_(pa.list_(pa.int64()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    spans = base_spans(text)
                    counts = [sum(kind == k for _, kind, _ in spans) for k in range(3)]
                    places = [m.span() for m in _CANDIDATE.finditer(text or "")]
                    labels = [int(overlaps(place, spans)) for place in places]
                    rows.append((doc_id, *counts, digest(spans, KINDS), [s[0] for s in spans], [s[1] for s in spans],
                                 [s[2] for s in spans], [p[0] for p in places], [p[1] for p in places], labels,
                                 [windows(text, *p) for p in places],
                                 [[int(label and overlaps(piece, spans)) for piece in pieces(*p)] for p, label in zip(places, labels)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[i] for row in rows], f.type) for i, f in enumerate(schema)], schema=schema
                )

    return documents.select("doc_id", "text").mapInArrow(
        run, _FOUND + ", c_windows array<array<string>>, w_labels array<array<long>>"
    )


def labelled_sample(table: DataFrame, findings: int, others: int) -> list[tuple[int, int, str]]:
    """(label, draw, window) of at most that many distinct windows, those of the smallest draws.

    Every task keeps its own smallest draws, so only bounded lists leave it. Copies of a
    window have one draw and count once.
    """
    limits = {0: others, 1: findings}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {0: [], 1: []}
        seen: dict[int, set] = {0: set(), 1: set()}
        for batch in batches:
            for labels, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for label, window in zip(chain.from_iterable(labels), chain.from_iterable(found)):
                    draw = xxhash.xxh3_64_intdigest(window) - (1 << 63)
                    heap = held[label]
                    if draw in seen[label] or len(heap) == limits[label] and draw >= -heap[0][0]:
                        continue
                    seen[label].add(draw)
                    heapq.heappush(heap, (-draw, window))
                    if len(heap) > limits[label]:
                        seen[label].discard(-heapq.heappop(heap)[0])
        rows = [(label, -draw, window) for label, heap in held.items() for draw, window in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[0] for row in rows], pa.int64()), pa.array([row[1] for row in rows], pa.int64()),
             pa.array([row[2] for row in rows], pa.string())], names=["label", "draw", "window"],
        )

    rows = table.select("w_labels", "c_windows").mapInArrow(run, "label long, draw long, window string")
    rows = write_through(rows.distinct())
    return [tuple(row) for label, limit in limits.items()
            for row in rows.where(F.col("label") == label).orderBy("draw").limit(limit).collect()]


def distinct_windows(found: DataFrame) -> DataFrame:
    """(label, draw, window) of all distinct windows; the draw deals them to parts and shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {
                one
                for labels, read in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for one in zip(chain.from_iterable(labels), chain.from_iterable(read))
            }
            draws = [xxhash.xxh3_64_intdigest(window) - (1 << 63) for _, window in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[0] for row in rows], pa.int64()), pa.array(draws, pa.int64()),
                 pa.array([row[1] for row in rows], pa.string())], names=["label", "draw", "window"],
            )

    rows = found.select("w_labels", "c_windows").mapInArrow(run, "label long, draw long, window string")
    return write_through(rows.distinct())


def doubted(network: Network, codes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Windows without a pattern, with letters and digits, that the network takes for a finding."""
    out = (labels == 0) & mixed(codes)
    out[out] = network.probability(raised(masked(codes[out]))) >= 0.5
    return out


def learn_shards(windows: DataFrame, shards: int, start: Network, first: Network | None = None) -> tuple[Network, int]:
    """The mean, by windows, of what each shard learns from its own, and how many were left out.

    Every shard learns all its windows in all forms, but for those that ``first`` doubts.
    """
    values, doubts = start.parameters(), None if first is None else first.parameters()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("draw", "ascending"), ("label", "ascending"), ("window", "ascending")])
        codes, labels = encode(table["window"].to_pylist()), table["label"].to_numpy().astype(np.float32)
        network, kept = Network().with_parameters(values), np.ones(len(labels), bool)
        if doubts is not None:
            kept = ~doubted(Network().with_parameters(doubts), codes, labels)
        if kept.any():
            network.train(*forms(codes[kept], labels[kept]), rounds=1, size=256, steps=0, rate=1e-3)
        learned = network.parameters().astype(np.float64)
        sums = np.rint(learned * _PARTS).astype(np.int64) * int(kept.sum())
        sums = np.concatenate([sums, [kept.sum(), (~kept).sum()]])
        return pa.table({"place": pa.array(np.arange(len(sums)), pa.int64()), "total": pa.array(sums, pa.int64())})

    dealt = windows.where(F.pmod("draw", F.lit(4)) > 1).withColumn("shard", F.pmod(F.shiftright("draw", 2), F.lit(shards)))
    made = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(run, "place long, total long")
    rows = made.groupBy("place").agg(F.sum("total").alias("total")).orderBy("place").collect()
    sums = [row["total"] for row in rows]
    return start.with_parameters(np.array(sums[:-2], np.float64) / max(1, sums[-2]) / _PARTS), sums[-1]


def score_counts(windows: DataFrame, network: Network) -> np.ndarray:
    """(part, label, step of the score, n) of the windows that calibrate, in all forms, and measure, masked."""
    values = network.parameters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Network().with_parameters(values)
        for batch in batches:
            codes, labels = encode(batch.column(2).to_pylist()), batch.column(0).to_numpy()
            part = batch.column(1).to_numpy() % 4
            for number, (read, of) in enumerate([forms(codes[part == 0], labels[part == 0]),
                                                 (masked(codes[part == 1]), labels[part == 1])]):
                steps = np.rint(reader.logits(read) * _STEPS).astype(np.int64)
                found, counts = np.unique(np.stack([of, steps]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), number), pa.int64()), pa.array(found[0], pa.int64()),
                     pa.array(found[1], pa.int64()), pa.array(counts, pa.int64())], names=["part", "label", "step", "n"],
                )

    kept = windows.where(F.pmod("draw", F.lit(4)) < 2).mapInArrow(run, "part long, label long, step long, n long")
    rows = kept.groupBy("part", "label", "step").agg(F.sum("n").alias("n")).orderBy("part", "label", "step").collect()
    return np.array([tuple(row) for row in rows], np.int64).reshape(-1, 4)


def learn(
    found: DataFrame, recall: float = 0.95, alarms: float = 0.01, findings: int = 1500, others: int = 3000
) -> Network:
    """A calibrated network, learned, calibrated and measured on all distinct windows.

    If a part lacks either kind, nothing can be measured and the network is not used; it never
    fires. ``findings`` and ``others`` bound the sample it starts from. A window without a pattern may
    be a secret all the same: those with letters and digits that a first network takes for one
    are left out of what the second learns.
    """
    network = Network()
    windows = distinct_windows(found)
    parts = windows.groupBy(F.pmod("draw", F.lit(4)).alias("part"), "label").count().collect()
    if {(min(row["part"], 2), row["label"]) for row in parts} != {(part, label) for part in range(3) for label in (0, 1)}:
        return network
    shards = -(-sum(row["count"] for row in parts if row["part"] > 1) // _SHARD)
    sample = [row for row in labelled_sample(found, findings, others) if row[1] % 4 > 1]
    labels, codes = np.array([row[0] for row in sample], np.float32), encode([row[2] for row in sample])
    if sample:
        network.train(*forms(codes, labels))
    first, _ = learn_shards(windows, shards, network)
    kept = ~doubted(first, codes, labels)
    if kept.any() and not kept.all():
        network = Network()
        network.train(*forms(codes[kept], labels[kept]))
    network, _ = learn_shards(windows, shards, network, first)
    scores = score_counts(windows, network)
    for part, use, limit in [(0, network.calibrate_counted, recall), (1, network.measure_counted, alarms)]:
        rows = scores[scores[:, 0] == part]
        use(rows[:, 2] / _STEPS, rows[:, 1], rows[:, 3], limit)
    return network


def secrets(
    documents: DataFrame, recall: float = 0.95, alarms: float = 0.01, findings: int = 1500, others: int = 3000
) -> DataFrame:
    """doc_id, counts and digest of the pattern spans, and ``spans``, those of the network included.

    The network judges every candidate that no pattern span overlaps; a candidate of several
    windows has the score of its best one. ``network_recall`` and ``network_alarms`` (share of windows
    without a finding that it fires at) are measured on windows kept apart and equal on all rows; if
    more than ``alarms`` of those fire, or nothing could be measured, the recall asked for cannot be had
    usefully: ``network_used`` is false and the patterns' spans stand alone. Null and empty
    texts have no spans; a null doc_id stays null; repeated rows get equal results; columns
    other than doc_id and text are not read. At most ``findings`` and ``others`` windows reach the
    driver, to start from; sums and counts do for the rest. Only distinct windows are shuffled.
    """
    found = write_through(find_base(documents))
    network = learn(found, recall, alarms, findings, others)

    def spans_of(starts: list, kinds: list, ends: list, c_starts: list, c_ends: list, labels: list, read: list) -> str:
        free = [i for i, label in enumerate(labels) if not label]
        spans = list(zip(starts, kinds, ends))
        if free and network.used:
            owners = [i for i in free for _ in read[i]]
            sure = network.probability(encode([window for i in free for window in read[i]]))
            met = {i for i, p in zip(owners, sure) if p >= network.threshold}
            spans += [(c_starts[i], 3, c_ends[i]) for i in met]
        return written(spans, KINDS)

    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    inputs = [*names, "starts", "kinds", "ends", "c_starts", "c_ends", "c_labels", "c_windows"]
    made = map_rows(found, inputs, lambda *row: (*row[:5], spans_of(*row[5:])),
                    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return made.select(
        "*", F.lit(network.used).alias("network_used"), F.lit(network.recall).cast("double").alias("network_recall"),
        F.lit(network.alarms).cast("double").alias("network_alarms"),
    )
