"""Secret scans: fixed patterns, and a character convolutional network for what they miss.

Patterns give the base findings, which always stay. Further candidates are long runs of key characters
with a digit. A small network in numpy reads each candidate with the text around it. It is trained on all
distinct labelled findings: base findings count as secrets, also the values of assignments without
their keyword, as a candidate would show them. No secrets are ordinary words (the first long one of each
text) and candidates that something other than their kind speaks against (form of a number, repetition,
running numbers); the rest has no label. Findings are dealt into pieces of bounded size; in each round every
piece takes one pass from the common weights, and the weights it arrives at are averaged. The output is
calibrated on all findings held back from training (those of a fifth of the values). The threshold is the largest that still finds
``recall`` of the held-back values without keyword; where no held-back window without a secret reaches it, it
lies half-way (in log-odds) down to the highest of those, which leaves room for keys of another form and costs
nothing. Candidates at or above it are added.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import slices, stored
from tillwatch.llm.quality import platt, platt_of
from tillwatch.operators.quantiles import exact_quantiles

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
OTHER = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
WORD = re.compile(r"[^\W\d_]{8,}")
KINDS = ("assign", "access", "hex", "network")
SECRET = ("assign", "access", "hex", "free")
#: Digits as in card, phone, account and date numbers; a short piece over and over.
NUMBER, REPEATED = "^[0-9]+([-_/=+][0-9]+)*$", r"^(.{1,5}?)\1{2,}.{0,4}$"
MOST_DIGITS, RUNNING = 19, 20
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_DIGIT = re.compile(rb"[0-9]")
BEFORE, AFTER, SEGMENT = 24, 8, 256
#: Places of a training step; a window with more of them goes alone, in segments.
STEP = 64 * 2 * SEGMENT
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 +/_.=-:\"'\n@,;()<>"
_NUMBER = {c: i + 1 for i, c in enumerate(ALPHABET)}
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
FOUND = "array<struct<kind:string,start:bigint,end:bigint,before:string,body:string,after:string>>"


@dataclass(frozen=True)
class SecretModel:
    """``piece``, ``piece_chars``: findings and characters of a piece, on average; ``epochs``: rounds over all findings."""

    piece: int = 8192
    piece_chars: int = 2 << 20
    recall: float = 0.99
    epochs: int = 6
    filters: int = 16
    width: int = 5
    embedding: int = 8
    seed: int = 42


def candidates(text: str) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, value start, value end) of a whole text; kind "other" is for the network to judge."""
    raw = text.encode()
    found = []
    low = raw.lower()
    if any(w in low for w in _WORDS):
        found += [("assign", *m.span(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if b"AKIA" in raw:
        found += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    if not _DIGIT.search(raw) and not _HEX_LETTERS.search(raw):
        return found
    found += [("hex", *m.span(), *m.span()) for m in HEX.finditer(text)]
    taken = sorted((s, e) for _, s, e, _, _ in found)
    for m in OTHER.finditer(text):
        if any(c.isdigit() for c in m.group()) and not any(s < m.end() and m.start() < e for s, e in taken):
            found.append(("other", *m.span(), *m.span()))
    return found


_HEX_LETTERS = re.compile(rb"[a-f]{24}")


def _windows(text: str, spans) -> list[dict]:
    made = []
    for k, s, e, a, b in spans:
        begin = s if k == "free" else a
        made.append({"kind": k, "start": s, "end": e, "before": text[max(0, begin - BEFORE):begin], "body": text[a:b],
                     "after": text[b:b + AFTER]})
    return made


def _free(text: str, spans) -> list[tuple[str, int, int, int, int]]:
    """Values of assignments that would be candidates without their keyword."""
    return [("free", s, e, a, b) for k, s, e, a, b in spans
            if k == "assign" and OTHER.fullmatch(text, a, b) and any(c.isdigit() for c in text[a:b])]


def find_candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found): candidates of each row with the text around them; for training, values of assignments
    without their keyword ("free") and the first long word."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for batch in slices(batches, "text"):
            made = []
            for text in batch.column("text").to_pylist():
                spans = candidates(text)
                spans += _free(text, spans)
                if word := WORD.search(text):
                    spans = [*spans, ("word", *word.span(), *word.span())]
                made.append(_windows(text, spans))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, _FOUND_TYPE)], ["doc_id", "found"])

    return rows.mapInArrow(work, f"doc_id {kind}, found {FOUND}")


_FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("before", pa.string()), ("body", pa.string()), ("after", pa.string())]))
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                 ("score", pa.float64())]))


def _numbers(rows: list[dict]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for r in rows:
        text = r["before"] + r["body"] + r["after"]
        part = np.repeat([0, 1, 2], [len(r["before"]), len(r["body"]), len(r["after"])])
        out.append((np.array([_NUMBER.get(c, 0) for c in text], np.int64), part))
    return out


class Network:
    """Embedding and part of the window, convolution, ReLU, maximum and mean over places, logistic output."""

    def __init__(self, spec: SecretModel):
        draw = np.random.default_rng(spec.seed)
        n_in = spec.width * (spec.embedding + 3)
        self.spec = spec
        self.p = {"e": draw.normal(0, 0.3, (len(ALPHABET) + 1, spec.embedding)),
                  "w": draw.normal(0, 1 / np.sqrt(n_in), (n_in, spec.filters)), "b": np.zeros(spec.filters),
                  "o": draw.normal(0, 0.3, 2 * spec.filters), "c": np.zeros(1)}
        self.scale, self.shift, self.threshold = 1.0, 0.0, 1.0

    def _unfold(self, chars, parts, there):
        x = np.concatenate([self.p["e"][chars], np.eye(3)[parts]], 2) * there[:, :, None]
        side = self.spec.width // 2
        wide = np.pad(x, ((0, 0), (side, side), (0, 0)))
        return np.concatenate([wide[:, i:i + x.shape[1]] for i in range(self.spec.width)], 2)

    def forward(self, chars, parts, there):
        cols = self._unfold(chars, parts, there)
        act = np.maximum(cols @ self.p["w"] + self.p["b"], 0) * there[:, :, None]
        top, mean = act.max(1), act.sum(1) / there.sum(1)[:, None]
        pooled = np.concatenate([top, mean], 1)
        return pooled @ self.p["o"] + self.p["c"][0], (cols, act, pooled)

    def step(self, chars, parts, there, y, weight, state, rate=0.01):
        margin, (cols, act, pooled) = self.forward(chars, parts, there)
        n, f = len(y), self.spec.filters
        off = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / n
        back = off[:, None] * self.p["o"][None]
        d = np.repeat((back[:, f:] / there.sum(1)[:, None])[:, None], act.shape[1], 1)
        i, k = np.indices((n, f))
        d[i, act.argmax(1), k] += back[:, :f]
        self._move({**self._slopes(chars, there, cols, d * (act > 0)), "o": pooled.T @ off, "c": off.sum()[None]}, state, rate)

    def _slopes(self, chars, there, cols, d):
        """Slopes of embedding, convolution and bias from those ``d`` of the convolution's output."""
        d_cols = d @ self.p["w"].T
        size, side = self.spec.embedding + 3, self.spec.width // 2
        d_wide = np.zeros((len(d), d.shape[1] + 2 * side, size))
        for j in range(self.spec.width):
            d_wide[:, j:j + d.shape[1]] += d_cols[:, :, j * size:(j + 1) * size]
        d_x = d_wide[:, side:side + d.shape[1], :self.spec.embedding] * there[:, :, None]
        d_e = np.zeros_like(self.p["e"])
        np.add.at(d_e, chars, d_x)
        return {"e": d_e, "w": np.tensordot(cols, d, ((0, 1), (0, 1))), "b": d.sum((0, 1))}

    def step_long(self, chars, parts, y, weight, state, rate=0.01):
        """``step`` for one window of any length, in segments: one pass for the pooled values, one for the slopes."""
        side, f = self.spec.width // 2, self.spec.filters
        starts = range(0, len(chars), SEGMENT)
        cut = [slice(max(0, a - side), a + SEGMENT + side) for a in starts]
        top, total, where = np.full(f, -1.0), np.zeros(f), np.zeros((f, 2), np.int64)

        def through(j):
            batch = _padded([(chars[cut[j]], parts[cut[j]])])
            _, (cols, act, _) = self.forward(*batch)
            skip = starts[j] - cut[j].start
            return batch, cols, act, slice(skip, skip + min(SEGMENT, len(chars) - starts[j]))

        for j in range(len(cut)):
            _, _, act, own = through(j)
            best = act[0, own].argmax(0)
            high = act[0, own].max(0)
            where[high > top] = np.stack([np.full(f, j), best + own.start], 1)[high > top]
            top, total = np.maximum(top, high), total + act[0, own].sum(0)
        pooled = np.concatenate([top, total / len(chars)])
        off = weight * (1 / (1 + np.exp(-np.clip(pooled @ self.p["o"] + self.p["c"][0], -30, 30))) - y)
        grads = {k: np.zeros_like(self.p[k]) for k in ("e", "w", "b")} | {"o": pooled * off, "c": np.array([off])}
        for j in range(len(cut)):
            batch, cols, act, own = through(j)
            d = np.zeros_like(act)
            d[0, own] = off * self.p["o"][f:] / len(chars)
            mine = np.flatnonzero(where[:, 0] == j)
            d[0, where[mine, 1], mine] += off * self.p["o"][mine]
            for k, g in self._slopes(batch[0], batch[2], cols, d * (act > 0)).items():
                grads[k] += g
        self._move(grads, state, rate)

    def _move(self, grads, state, rate):
        """One step of Adam."""
        state["t"] += 1
        for name, g in grads.items():
            m, v = state.setdefault(name, [np.zeros_like(g), np.zeros_like(g)])
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.p[name] = self.p[name] - rate * (m / (1 - 0.9 ** state["t"])) / (np.sqrt(v / (1 - 0.999 ** state["t"])) + 1e-8)

    def epoch(self, rows: list[dict], order: np.ndarray, share: float, state: dict) -> None:
        """One pass over ``rows`` in ``order``; ``share``: of secrets among all findings for training."""
        y = np.array([r["kind"] in SECRET for r in rows], float)
        weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
        whole = _numbers(rows)
        for part in _steps(order, [len(c) for c, _ in whole]):
            if len(part) == 1 and len(whole[part[0]][0]) > STEP:
                self.step_long(*whole[part[0]], y[part[0]], weight[part[0]] / 64, state)
            else:
                self.step(*_padded([whole[i] for i in part]), y[part], weight[part] * len(part) / 64, state)

    def flat(self, state: dict) -> np.ndarray:
        """Weights and moments of Adam in a row."""
        names = sorted(self.p)
        still = [[np.zeros_like(self.p[k])] * 2 for k in names]
        return np.concatenate([self.p[k].ravel() for k in names] + [
            x.ravel() for k, none in zip(names, still) for x in state.get(k, none)])

    def unflat(self, values: np.ndarray, t: int) -> dict:
        """Take the weights of ``flat``; the state of Adam after ``t`` steps."""
        at, state = 0, {"t": t}

        def piece(like):
            nonlocal at
            at += like.size
            return values[at - like.size:at].reshape(like.shape).copy()

        for k in sorted(self.p):
            self.p[k] = piece(self.p[k])
        for k in sorted(self.p):
            state[k] = [piece(self.p[k]), piece(self.p[k])]
        return state

    def margins(self, rows: list[dict]) -> np.ndarray:
        """Margin of each window of any length: long ones in overlapping segments, pooled together."""
        side, f = self.spec.width // 2, self.spec.filters
        pieces, owner = [], []
        numbers = _numbers(rows)
        for i, (chars, parts) in enumerate(numbers):
            for a in range(0, max(1, len(chars)), SEGMENT):
                lo, hi = max(0, a - side), a + SEGMENT + side
                pieces.append((chars[lo:hi], parts[lo:hi], a - lo, min(SEGMENT, len(chars) - a)))
                owner.append(i)
        top, total = np.full((len(rows), f), 0.0), np.zeros((len(rows), f))
        for k in range(0, len(pieces), 512):
            chars, parts, there = _padded([p[:2] for p in pieces[k:k + 512]])
            _, (_, act, _) = self.forward(chars, parts, there)
            for j, (_, _, skip, n) in enumerate(pieces[k:k + 512]):
                own = act[j, skip:skip + n]
                if n > 0:
                    top[owner[k + j]] = np.maximum(top[owner[k + j]], own.max(0))
                    total[owner[k + j]] += own.sum(0)
        size = np.array([max(1, len(c)) for c, _ in numbers])
        return np.concatenate([top, total / size[:, None]], 1) @ self.p["o"] + self.p["c"][0]

    def scores(self, rows: list[dict]) -> np.ndarray:
        return self.probability(self.margins(rows))

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * margins + self.shift, -30, 30)))


def _padded(numbers):
    long = max(1, max(len(c) for c, _ in numbers))
    chars, parts, there = (np.zeros((len(numbers), long), np.int64) for _ in range(3))
    for i, (c, p) in enumerate(numbers):
        chars[i, :len(c)], parts[i, :len(p)], there[i, :len(c)] = c, p, 1
    there[:, 0] = 1
    return chars, parts, there


def train(rows: list[dict], spec: SecretModel) -> Network | None:
    """A calibrated network from labelled windows (kind, before, body, after, fold); None if one class is missing."""
    y = np.array([r["kind"] in SECRET for r in rows], float)
    held = np.array([r["fold"] == 0 for r in rows], bool)
    if not rows or min(y[~held].sum(), (1 - y[~held]).sum(), y[held].sum(), (1 - y[held]).sum()) < 5:
        return None
    net, state = Network(spec), {"t": 0}
    draw = np.random.default_rng(spec.seed)
    fit = np.flatnonzero(~held)
    for _ in range(spec.epochs):
        draw.shuffle(fit)
        net.epoch(rows, fit, y[~held].mean(), state)
    kept = [r for r, h in zip(rows, held) if h]
    net.scale, net.shift = platt(net.margins(kept), y[held])
    p, kinds = net.scores(kept), np.array([r["kind"] for r in kept])
    measured = kinds == "free" if (kinds == "free").any() else np.isin(kinds, SECRET)
    net.threshold = _between(np.quantile(p[measured], 1 - spec.recall, method="lower"), p[y[held] == 0].max())
    return net


def _between(bound: float, none: float) -> float:
    """``bound``, or half-way (in log-odds) down to ``none`` where that is lower."""
    if none < bound:
        odds = np.log([bound / (1 - bound), none / (1 - none)]).mean()
        bound = 1 / (1 + np.exp(-odds))
    return float(bound)


def train_all(each: DataFrame, spec: SecretModel) -> Network | None:
    """``train`` on a stored table of labelled windows (kind, before, body, after, fold, mark) of any size.

    What fits into one piece is trained in one. Otherwise only averaged weights and sums reach the driver.
    """
    secret, held = F.col("kind").isin(*SECRET), F.col("fold") == 0
    chars = F.length("before") + F.length("body") + F.length("after")
    there = each.groupBy(held.alias("held"), secret.alias("secret")).agg(F.count(F.lit(1)).alias("n"), F.sum(chars).alias("chars")).collect()
    n = {(r["held"], r["secret"]): r["n"] for r in there}
    pieces = max(-(-sum(n.values()) // spec.piece), -(-sum(r["chars"] for r in there) // spec.piece_chars))
    if pieces <= 1:
        return train(sorted((r.asDict() for r in each.collect()), key=lambda r: (r["mark"], r["kind"], r["body"])), spec)
    if min(n.get((h, s), 0) for h in (True, False) for s in (True, False)) < 5:
        return None
    dealt = each.filter(~held).withColumn("piece", F.pmod(F.xxhash64("mark", F.lit(3)), F.lit(pieces)))
    share = n[False, True] / (n[False, True] + n[False, False])
    net, state = Network(spec), {"t": 0}
    for i in range(spec.epochs):
        state = _round(dealt, net, state, share, i)
    model = each.sparkSession.sparkContext.broadcast(net)

    def judge(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(model.value.margins(batch.to_pylist()))], ["kind", "margin"])

    judged = each.filter(held).mapInArrow(judge, "kind string, margin double").select("kind", secret.cast("double").alias("y"), "margin")
    judged = stored(judged, "secret-held")
    net.scale, net.shift = platt_of(judged, ["margin"])[0]
    measured = judged.filter(F.col("kind") == "free")
    measured = judged.filter("y = 1") if measured.isEmpty() else measured
    down = net.scale < 0
    share = round(spec.recall if down else 1 - spec.recall, 12)
    low = exact_quantiles(measured, "margin", {"low": share}).first()["low"]
    none = judged.filter("y = 0").agg((F.min if down else F.max)("margin")).first()[0]
    net.threshold = _between(*net.probability(np.array([low, none])).tolist())
    return net


def _round(dealt: DataFrame, net: Network, state: dict, share: float, number: int) -> dict:
    """One pass over every piece from the weights of ``net``, then the mean of what they arrive at, by rows."""
    begin = dealt.sparkSession.sparkContext.broadcast((net.spec, net.flat(state), state["t"]))

    def work(table: pa.Table) -> pa.Table:
        spec, values, t = begin.value
        rows = sorted(table.to_pylist(), key=lambda r: (r["mark"], r["kind"], r["body"]))
        mine, piece = Network(spec), rows[0]["piece"]
        moved = mine.unflat(values, t)
        order = np.random.default_rng([spec.seed, number, piece]).permutation(len(rows))
        mine.epoch(rows, order, share, moved)
        return _sums([piece], [len(rows)], [(moved["t"] - t) * len(rows)], [mine.flat(moved) * len(rows)])

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        return _sums([rows[0]["piece"]], [sum(r["n"] for r in rows)], [sum(r["steps"] for r in rows)],
                     [np.sum([r["values"] for r in rows], 0)])

    schema = "piece bigint, n bigint, steps bigint, values array<double>"
    done = dealt.groupBy("piece").applyInArrow(work, schema)
    done = done.groupBy(F.pmod("piece", F.lit(64)).alias("lane")).applyInArrow(add, schema)
    found = sorted(done.collect(), key=lambda r: r["piece"])
    n = sum(r["n"] for r in found)
    return net.unflat(np.sum([r["values"] for r in found], 0) / n, state["t"] + sum(r["steps"] for r in found) // n)


def _sums(piece, n, steps, values) -> pa.Table:
    return pa.table({"piece": pa.array(piece, pa.int64()), "n": pa.array(n, pa.int64()), "steps": pa.array(steps, pa.int64()),
                     "values": pa.array([v.tolist() for v in values], pa.list_(pa.float64()))})


def _steps(order: np.ndarray, sizes: list[int], most: int = STEP):
    """Batches of up to 64 windows that fill at most ``most`` places when padded (one window at least)."""
    start = 0
    while start < len(order):
        end, long = start, 1
        while end < len(order) and end - start < 64:
            long = max(long, sizes[order[end]])
            if end > start and long * (end - start + 1) > most:
                break
            end += 1
        yield order[start:end]
        start = end


def labelled(each: DataFrame) -> DataFrame:
    """The windows of ``each`` that may be used for training, with their ``label``: base, free, none.

    A candidate is none only by its form, or where at least RUNNING values differ in one number alone.
    """
    digits = F.length(F.regexp_replace("body", "[^0-9]", ""))
    number = F.col("body").rlike(NUMBER) & (digits <= MOST_DIGITS)
    plain = number | F.col("body").rlike(REPEATED)
    label = (F.when(F.col("kind").isin(*KINDS), "base").when((F.col("kind") == "free") & ~plain, "free")
             .when((F.col("kind") == "word") | ((F.col("kind") == "other") & plain), "none"))
    stem = F.regexp_replace("body", "[0-9]+", "#")
    numbered = (each.filter((F.col("kind") == "other") & ~plain).withColumn("stem", stem)
                .filter((digits <= MOST_DIGITS) & (F.col("stem") != "#") & (F.length(F.regexp_replace("stem", "[^#]", "")) == 1)))
    running = numbered.select("stem", "body").distinct().groupBy("stem").count().filter(F.col("count") >= RUNNING)
    counted = numbered.join(running, "stem", "left_semi").drop("stem").withColumn("label", F.lit("none"))
    return each.withColumn("label", label).filter("label IS NOT NULL").unionByName(counted)


def scan_secrets(docs: DataFrame, spec: SecretModel = SecretModel(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) for each row of ``docs``: spans (kind, start, end, score), by start and kind.

    Offsets are code points, ends exclusive. ``score`` is the network's probability, NULL without a network
    (too few labelled findings). Kind "network" marks the added spans. A NULL text counts as empty. Every
    row stays, also repeated ones. Texts are read once; later steps see the candidates only.
    """
    found = stored(find_candidates(docs, doc_id, text), "secret-candidates")
    each = found.select(F.explode("found").alias("f")).select("f.*")
    each = each.withColumn("mark", F.xxhash64("kind", "before", "body", "after"))
    each = each.withColumn("fold", F.pmod(F.xxhash64("body"), F.lit(5)))
    part = ["kind", "before", "body", "after", "fold", "mark"]
    each = stored(labelled(each.select(part).distinct()), "secret-labelled").drop("label")
    net = docs.sparkSession.sparkContext.broadcast(train_all(each, spec))
    kind = found.schema["doc_id"].dataType.simpleString()

    def work(batches):
        model = net.value
        for batch in batches:
            made = []
            for row in batch.column("found").to_pylist():
                row = [r for r in row if r["kind"] not in ("word", "free")]
                p = model.scores(row).tolist() if row and model else [None] * len(row)
                spans = []
                for r, score in zip(row, p):
                    if r["kind"] == "other" and (score is None or score < model.threshold):
                        continue
                    name = "network" if r["kind"] == "other" else r["kind"]
                    spans.append({"kind": name, "start": r["start"], "end": r["end"], "score": score})
                made.append(sorted(spans, key=lambda s: (s["start"], KINDS.index(s["kind"]))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, _SPAN_TYPE)], ["doc_id", "spans"])

    return found.mapInArrow(work, f"doc_id {kind}, spans {SPANS}")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "network")
    counts = [count(kind) for kind in KINDS[:3]]
    return scanned.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
