"""Secret scan: fixed patterns, and a linear-chain conditional random field over tokens.

The patterns find the base spans (values of assignments, access keys, long hexadecimal runs). The
field tags every token of a text as begin, inside or outside of a secret. Its features are

- of the token: its shape (classes of characters and runs of them, length, spread of characters,
  start), or what it is if it is a mark;
- of the neighbouring words: the two tokens before it and the one after it;
- of the file: how dense assignments are in it, and tokens with digits.

Weights are learned on the driver from a bounded sample of token windows (``TRAIN_WINDOWS``),
half around base spans and half from anywhere, whose tags come from the base spans. Equal windows count as
one (copies of a text, of whatever number, are one text to learn from), and different ones are
drawn by a hash of what they hold, so the sample keeps its bound and is the same on every run. Decoding is Viterbi's,
over whole texts. A token whose margin for *outside* exceeds what any choice of its two
transitions could win back is outside on every best path, so the chain is cut there and only
the stretches between such tokens are decoded: the result is that of decoding the whole chain.

Scale: one map over the documents for the windows, whose hashes are counted by partial aggregates and of
which only the sample (rows below a hash threshold) leaves the executors, and one for the scan. Both take
time in proportion to a text and the secrets in it (neighbouring intervals are found by bisection). The weights broadcast are a few
tables of ``BUCKETS`` rows whatever the input is.

Defined results: a null text is empty and has no spans; offsets are code points, end exclusive; a
span of the field that meets a base span is left out; a table without any base span trains no field
and gives the base spans alone; repeated rows are scanned row by row; a very long text is scanned whole, and
so is a very long token (only a training window is cut, ``2 * MARGIN`` characters from its secret); spans
that start together are listed in the order of ``KINDS``; columns other than id and text pass by unread.
"""

from __future__ import annotations

import bisect
import math
import re
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, drawn, map_columns, restored, rows, texts, with_columns, written

# The kinds of spans, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "crf")

# Fixed patterns of the base spans. The bounded forms of the last two find what the unbounded ones
# find once short matches are dropped: a run that is too short has no longer run inside it.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CUES = ("passw", "secret", "token", "api")
MIN_ASSIGNED = 6

TRAIN_WINDOWS = 4_000
#: tokens of a training window at most, and characters on either side that it is cut from
WINDOW = 40
MARGIN = 150
BUCKETS = 4_096
EPOCHS = 60
L2 = 2e-3

OUTSIDE, BEGIN, INSIDE = range(3)
TOKEN = re.compile(r"[\w+/](?:[\w+/.\-]*[\w+/])?|[^\s\w]")

_MARKUP = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start and then kind as listed."""
    out = []
    low = text.lower()
    if any(cue in low for cue in ASSIGN_CUES):
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= MIN_ASSIGNED:
                out.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _secret_part(text: str, span: tuple[str, int, int]) -> tuple[int, int]:
    """Where the secret itself is within a base span (the value, of an assignment)."""
    kind, start, end = span
    return ASSIGN.match(text, start).span(1) if kind == "assign" else (start, end)


class Intervals:
    """Which of some intervals a stretch of text meets. Intervals of one kind do not overlap."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.kinds: dict[str, tuple[list[int], list[int], list[int]]] = {}
        for i, (kind, start, end) in enumerate(spans):
            for column, v in zip(self.kinds.setdefault(kind, ([], [], [])), (start, end, i)):
                column.append(v)

    def first(self, start: int, end: int) -> int | None:
        """The first of the intervals, as they were given, that meets [start, end)."""
        found = None
        for starts, ends, at in self.kinds.values():
            k = bisect.bisect_right(ends, start)  # those before end where the stretch begins, or before
            if k < len(starts) and starts[k] < end and (found is None or at[k] < found):
                found = at[k]
        return found


def _bucket(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature) % BUCKETS


_CLASS = {i: "d" if chr(i).isdigit() else "A" if chr(i).isupper() else "a" if chr(i).islower() else "." for i in range(128)}
_RUNS = re.compile(r"(.)\1+")
_HEX = re.compile(r"[0-9a-f]+")
_DIGITS = re.compile(r"[0-9]+")


def shape(token: str) -> tuple:
    """What the features of a token's own form depend on; characters past ASCII count as letters."""
    n = len(token)
    if n <= 2 and not token.isalnum():
        return (token,)
    classes = token.translate(_CLASS)
    digits, upper, marks = classes.count("d"), classes.count("A"), classes.count(".")
    length = min(n.bit_length() if n < 16 else 4 + n // 8, 12)
    return (
        (digits > 0, upper > 0, digits + upper + marks < n, marks > 0),
        length,
        min(len(_RUNS.sub(r"\1", classes)), 16) // 2,
        min(len(set(token)), 32) // 2,
        round(8 * digits / n),
        digits > 0 and _HEX.fullmatch(token) is not None,
        token[:4] if n >= 12 else "",
    )


def shape_features(form: tuple) -> list[str]:
    """Features of a token's own form (a ``shape``)."""
    if len(form) == 1:
        return ["bias", f"mark={form[0]}"]
    kind, length, runs, spread, digits, is_hex, start = form
    return [
        "bias",
        f"kind={kind}",
        f"kind,length={kind},{length}",
        f"runs={runs},{length}",
        f"spread={spread},{length}",
        f"digits={digits},{length}",
        f"hex={is_hex},{length}",
        f"start={start}",
    ]


def context_feature(token: str) -> str:
    """What a token is to its neighbours: itself if it is a word or a mark, else its form."""
    if len(token) <= 16 and not any(map(str.isdigit, token)):
        return token.lower()
    return f"#{len(token) // 8}{any(map(str.isalpha, token))}"


def file_features(text: str) -> list[str]:
    """Features of the file: how many assignment marks and runs of digits in a thousand characters."""
    grade = lambda x: int(math.log2(1 + 4000 * x / max(len(text), 1)))
    return [f"assign={grade(text.count('=') + text.count(':'))}", f"digits={grade(len(_DIGITS.findall(text)))}"]


#: places of neighbours, from the token
_PLACES = (-1, -2, 1)


class Field:
    """The weights: state scores by feature, and transitions (from, to)."""

    def __init__(self):
        self.own = np.zeros((BUCKETS, 3))
        self.near = np.zeros((len(_PLACES), BUCKETS, 3))
        self.file = np.zeros((BUCKETS, 3))
        self.move = np.zeros((3, 3))

    def margin_needed(self) -> np.ndarray:
        """For begin and inside: the most that two transitions can win over those of outside."""
        move = np.vstack([self.move, np.zeros(3)])  # a chain may also start or end here
        into = move - move[:, :1]
        out = np.hstack([self.move, np.zeros((3, 1))])
        onward = out - out[:1]
        return into[:, 1:].max(axis=0) + onward[1:].max(axis=1)


class Scorer:
    """Scores of tokens under a field. Of at most ``limit`` tokens it remembers the form and the
    context bucket, packed into one integer."""

    def __init__(self, field: Field, limit: int = 400_000):
        self.field, self.limit = field, limit
        self.needed = field.margin_needed()
        self.known: dict[str, int] = {}
        self.forms: dict[tuple, int] = {}
        self.own = np.zeros((1024, 3))

    def _form(self, form: tuple) -> int:
        k = self.forms.get(form)
        if k is None:
            k = self.forms[form] = len(self.forms)
            if k == len(self.own):
                self.own = np.concatenate([self.own, np.zeros_like(self.own)])
            self.own[k] = self.field.own[[_bucket(f) for f in shape_features(form)]].sum(axis=0)
        return k

    def _learn(self, token: str) -> int:
        form = self._form(shape(token))
        self.known[token] = code = form * BUCKETS + _bucket(context_feature(token))
        return code

    def scores(self, tokens: list[str], file: list[str]) -> np.ndarray:
        """State scores of the tokens of a text with the given file features."""
        if len(self.known) >= self.limit or len(self.forms) + len(tokens) >= self.limit:
            self.known.clear()
            self.forms.clear()
        get, learn = self.known.get, self._learn
        codes = np.array([get(t) or learn(t) for t in tokens])
        out = self.own[codes // BUCKETS]
        context = codes % BUCKETS
        for p, d in enumerate(_PLACES):
            near = self.field.near[p][context]
            if d < 0:
                out[-d:] += near[:d]
            else:
                out[:-d] += near[d:]
        return out + self.field.file[[_bucket(f) for f in file]].sum(axis=0)

    def tags(self, scores: np.ndarray) -> list[tuple[int, int]]:
        """(position, tag) of the tokens that the best path tags begin or inside."""
        lead = scores[:, :1] - scores[:, 1:]
        open_ = np.flatnonzero((lead <= self.needed).any(axis=1))
        if not len(open_):
            return []
        found = []
        for part in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
            a, b = int(part[0]), int(part[-1]) + 1
            path = viterbi(scores[a:b], self.field.move, a > 0, b < len(scores))
            found += [(a + i, y) for i, y in enumerate(path) if y]
        return found


def viterbi(scores: np.ndarray, move: np.ndarray, after: bool, before: bool) -> list[int]:
    """The best path; ``after`` and ``before``: an outside token precedes, follows."""
    best = (scores[0] + (move[OUTSIDE] if after else 0)).tolist()
    m, back = move.tolist(), []
    for e in scores[1:].tolist():
        step, now = [], []
        for y in range(3):
            c = [best[x] + m[x][y] for x in range(3)]
            x = c.index(max(c))
            step.append(x)
            now.append(c[x] + e[y])
        best = now
        back.append(step)
    if before:
        best = [b + m[y][OUTSIDE] for y, b in enumerate(best)]
    y = best.index(max(best))
    path = [y]
    for step in reversed(back):
        y = step[y]
        path.append(y)
    return path[::-1]


def crf_spans(text: str, scorer: Scorer, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the field that meet no base span."""
    tokens = TOKEN.findall(text)
    if not tokens:
        return []
    tags = scorer.tags(scorer.scores(tokens, file_features(text)))
    if not tags:
        return []
    at = [m.span() for m in TOKEN.finditer(text)]
    spans: list[list[int]] = []
    last = -2
    for i, y in tags:
        if y == INSIDE and i == last + 1:
            spans[-1][1] = at[i][1]
        else:
            spans.append([at[i][0], at[i][1]])
        last = i
    known = Intervals(base)
    return [("crf", a, b) for a, b in spans if known.first(a, b) is None]


def _cut_out(text: str, start: int, end: int) -> tuple[int, int]:
    """[start, end) widened to whole stretches between white space, by ``MARGIN`` characters at most."""
    first, last = max(0, start - MARGIN), min(len(text), end + MARGIN)
    while start > first and not text[start - 1].isspace():
        start -= 1
    while end < last and not text[end].isspace():
        end += 1
    return start, end


def training_windows(text: str) -> list[tuple[bool, list[str], list[int]]]:
    """(around a base span?, tokens, tags): the text about each base span, and about one place that
    a hash of the text names."""
    spans = base_spans(text)
    parts = [_secret_part(text, s) for s in spans]
    secrets = Intervals([(kind, a, b) for (kind, _, _), (a, b) in zip(spans, parts)])
    anywhere = xxhash.xxh3_64_intdigest(text) % max(len(text), 1)
    out = []
    for secret, a, b in [(False, anywhere, anywhere), *((True, a, b) for a, b in parts)]:
        a, b = _cut_out(text, max(0, a - MARGIN), min(len(text), b + MARGIN))
        tokens, tags, last = [], [], None
        for m in TOKEN.finditer(text, a, b):
            inside = secrets.first(m.start(), m.end())
            tokens.append(m.group())
            tags.append(OUTSIDE if inside is None else INSIDE if inside == last else BEGIN)
            last = inside
        if tokens:
            k = 0 if len(tokens) <= WINDOW else max(0, (len(tokens) - WINDOW) // 2)
            out.append((secret, tokens[k : k + WINDOW], tags[k : k + WINDOW]))
    return out


def _windows(batches):
    for (text,) in rows(batches, "_text"):
        out = []
        for t in text:
            file = None
            for secret, tokens, tags in training_windows(t):
                file = file or file_features(t)
                held = "\0".join([str(secret), *file, *map(str, tags), *tokens])  # all that is learned from it
                out.append((secret, xxhash.xxh3_64_intdigest(held) >> 1, tokens, tags, file))
        if out:
            kinds = (pa.bool_(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], ["secret", "draw", "tokens", "tags", "file"]
            )


#: a row of the weights that stays zero, for features that are not there
_PAD = BUCKETS
_OWN = 8


class Sample:
    """Training windows as arrays: features and tags of every token, padded to the longest window."""

    def __init__(self, windows: list):
        n, width = len(windows), max(len(w["tokens"]) for w in windows)
        self.n, self.width = n, width
        self.own = np.full((n, width, _OWN), _PAD)
        self.near = np.full((len(_PLACES), n, width), _PAD)
        self.file = np.full((n, 2), _PAD)
        y, size = np.zeros((n, width), int), np.zeros(n, int)
        for i, w in enumerate(windows):
            size[i] = len(w["tokens"])
            y[i, : size[i]] = w["tags"]
            self.file[i] = [_bucket(f) for f in w["file"]]
            context = [_bucket(context_feature(t)) for t in w["tokens"]]
            for j, t in enumerate(w["tokens"]):
                f = [_bucket(x) for x in shape_features(shape(t))]
                self.own[i, j, : len(f)] = f
                for p, d in enumerate(_PLACES):
                    if 0 <= j + d < size[i]:
                        self.near[p, i, j] = context[j + d]
        self.here = here = np.arange(width) < size[:, None]
        self.gold = np.eye(3)[y] * here[..., None]
        self.gold_move = np.zeros((3, 3))
        np.add.at(self.gold_move, (y[:, :-1][here[:, 1:]], y[:, 1:][here[:, 1:]]), 1)


def zero_weights() -> list[np.ndarray]:
    """Own, near, file and move weights, with the row of ``_PAD``."""
    return [np.zeros((BUCKETS + 1, 3)), np.zeros((len(_PLACES), BUCKETS + 1, 3)), np.zeros((BUCKETS + 1, 3)), np.zeros((3, 3))]


def likelihood(weights: list[np.ndarray], s: Sample) -> tuple[float, list[np.ndarray]]:
    """Log-likelihood of the tags and its gradient, by forward and backward sums over all taggings."""
    w_own, w_near, w_file, move = weights
    e = w_own[s.own].sum(axis=2) + w_file[s.file].sum(axis=1)[:, None, :]
    for p in range(len(_PLACES)):
        e += w_near[p][s.near[p]]
    here, width = s.here, s.width
    alpha, beta = np.zeros((s.n, width, 3)), np.zeros((s.n, width, 3))
    alpha[:, 0] = e[:, 0]
    for j in range(1, width):
        on = alpha[:, j - 1, :, None] + move
        top = on.max(axis=1)
        new = top + np.log(np.exp(on - top[:, None]).sum(axis=1)) + e[:, j]
        alpha[:, j] = np.where(here[:, j, None], new, alpha[:, j - 1])
    for j in range(width - 2, -1, -1):
        on = move + (e[:, j + 1] + beta[:, j + 1])[:, None, :]
        top = on.max(axis=2)
        beta[:, j] = np.where(here[:, j + 1, None], top + np.log(np.exp(on - top[..., None]).sum(axis=2)), 0.0)
    top = alpha[:, -1].max(axis=1)
    total = top + np.log(np.exp(alpha[:, -1] - top[:, None]).sum(axis=1))
    prob = np.exp(alpha + beta - total[:, None, None]) * here[..., None]
    pair = alpha[:, :-1, :, None] + move + (e + beta)[:, 1:, None, :] - total[:, None, None, None]
    pair = (np.exp(np.minimum(pair, 0)) * here[:, 1:, None, None]).sum(axis=(0, 1))
    diff = s.gold - prob

    def scatter(index: np.ndarray, grad: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(index.ravel(), grad[..., y].ravel(), BUCKETS + 1) for y in range(3)], axis=1)

    grads = [
        scatter(s.own, np.broadcast_to(diff[:, :, None, :], (*s.own.shape, 3))),
        np.stack([scatter(s.near[p], diff) for p in range(len(_PLACES))]),
        scatter(s.file, np.broadcast_to(diff.sum(axis=1)[:, None, :], (*s.file.shape, 3))),
        s.gold_move - pair,
    ]
    value = (e * s.gold).sum() + (move * s.gold_move).sum() - total.sum()
    return float(value), grads


def train(windows: list) -> Field:
    """Weights by regularised maximum likelihood (Adam steps)."""
    field, sample = Field(), Sample(windows)
    weights, first, second = zero_weights(), zero_weights(), zero_weights()
    for step in range(1, EPOCHS + 1):
        for k, g in enumerate(likelihood(weights, sample)[1]):
            g = g / sample.n - L2 * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            weights[k] += 0.2 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        weights[0][_PAD] = weights[2][_PAD] = 0
        weights[1][:, _PAD] = 0
    field.own, field.near, field.file, field.move = weights[0][:_PAD], weights[1][:, :_PAD], weights[2][:_PAD], weights[3]
    return field


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_windows: int = TRAIN_WINDOWS) -> Field | None:
    """A field trained on at most ``max_windows`` windows of ``docs``; None without base spans."""
    schema = "secret boolean, draw bigint, tokens array<string>, tags array<int>, file array<string>"
    windows = written(texts(docs, id_col, text_col).mapInArrow(_windows, schema), "windows")
    picked = []
    for secret in (True, False):
        own = windows.where(F.col("secret") == secret)
        below = drawn(own.select("draw").distinct(), F.col("draw"), max_windows // 2)
        # the draws below the threshold are few: of the windows only theirs move
        picked += own.join(F.broadcast(below), "draw", "left_semi").dropDuplicates(["draw"]).collect()
    picked.sort(key=lambda w: (w["draw"], w["tokens"]))
    return train(picked) if any(w["secret"] for w in picked) else None


def _scan(shared, batches, keep_text=False):
    field = shared.value
    scorer = Scorer(field) if field is not None else None
    for b in batches:
        out = []
        for t in b.column("_text").to_pylist():
            base = base_spans(t)
            extra = crf_spans(t, scorer, base) if scorer else []
            spans = sorted([*base, *extra], key=lambda s: (s[1], KINDS.index(s[0])))
            out.append([{"kind": k, "start": x, "end": y} for k, x, y in spans])
        yield with_columns(b, () if keep_text else ("_text",), spans=pa.array(out, _MARKUP))


def find_secrets(docs: DataFrame, field: Field | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id and spans (kind, start, end), by start and then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    found = map_columns(texts(docs, id_col, text_col), partial(_scan, shared), ("_text",), spans=spans)
    return found.select(F.col("_id").alias(id_col), "spans")


def redact_text(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with every stretch that spans cover replaced by one mark."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _redact(shared, mark, batches):
    for b in _scan(shared, batches, keep_text=True):
        out = []
        for t, spans in zip(b.column("_text").to_pylist(), b.column("spans").to_pylist()):
            out.append(redact_text(t, [(s["start"], s["end"]) for s in spans], mark) if spans else t)
        yield with_columns(b, ("spans",), _text=pa.array(out, pa.string()))


def redact(
    docs: DataFrame, field: Field | None, *, text_col: str = "text", length_col: str | None = None, mark: str = "[SECRET]"
) -> DataFrame:
    """``docs`` with every secret replaced by ``mark`` (null texts become empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    done = map_columns(carried(docs, text_col), partial(_redact, shared, mark), _text="string")
    return restored(done, docs, text_col, F.col("_text"), length_col)
