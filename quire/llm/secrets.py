"""Secret scan: base patterns, and a linear-chain conditional random field that adds spans.

Tokens of a text are tagged outside (O), begin (B) or inside (I) of a secret. A tag's score is a sum over the
token's shape, the shapes of its two neighbours and features of the whole file; neighbouring tags have a
transition score; the best sequence is found by Viterbi.

The field is trained on the spans of the base patterns, in windows of at most ``WINDOW`` tokens, from a bounded
sample of documents (``SAMPLE_ROWS`` rows are looked at; at most ``TRAIN_WINDOWS`` windows with and as many without
a secret are used). Scanning covers every token of every text.

A field that saw all cues of the base patterns would only learn these again. So each text with a secret
is also learnt with another random string in the secret's place, of another alphabet, length and form (``ALPHABETS``),
each one without with such a string between two of its words, and at every step each window hides a share ``HIDDEN`` of its cues (a feature of tokens in one role, or of the file),
drawn anew: weight goes to whatever marks a secret, its length, its mixed letters and digits, what stands beside it.
Windows without a secret are cut, by turns, around the token that looks most like one and around any.

Base patterns (fixed values). Spans are whole matches in code points, end exclusive:

* ``assign``: a keyword, ``=`` or ``:`` and a value (group 2) of six characters or more
* ``access``: ``AKIA`` and capitals or digits, twenty characters or more
* ``hex``: lower-case hexadecimal digits, twenty-four or more

Spans that the field adds have the kind ``crf`` and never touch a base span; base spans always stay.

Defined cases: a null text is the empty text, which has no spans; repeated rows give repeated results; an empty
table gives an empty result; an empty sample trains a field that tags nothing, so only base spans are returned;
a text of any length is tagged whole; of base spans that begin at one place the kind listed first comes first; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table, texts_of

SAMPLE_ROWS = 20_000
TRAIN_WINDOWS = 300
WINDOW = 100
STEPS = 60
RATE = 0.3
HIDDEN = 0.5
MASKS = 16
TOKENS_AT_ONCE = 300_000

# The base patterns. Letters of the keyword may be of either case, ASCII only.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join(re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", k) for k in KEYWORDS)
ASSIGN = re.compile(rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # the runs of AKIA[A-Z0-9]+ with 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ with 24 characters or more
KINDS = ("assign", "access", "hex", "crf")

# What other secrets are written with.
ALPHABETS = {
    "lower hex": "0123456789abcdef", "upper hex": "0123456789ABCDEF",
    "capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "small letters": "abcdefghijklmnopqrstuvwxyz0123456789",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
FORMS = ("plain", "prefix", "parts", "padded")

TOKEN = re.compile(r"[\w+/.=-]+|[^\w\s+/.=-]+")
_TRIGGER = re.compile(r"passw|pwd|secret|token|api_?key|credential|auth|private|akia")
O, B, I = 0, 1, 2  # noqa: E741

FOUND = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
         "n_added long")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns in order; kind is an index into ``KINDS``."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def secret_parts(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves are: the value of an assignment, the whole of other matches."""
    found = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [m.span() for rx in (ACCESS, HEX) for m in rx.finditer(text)]
    return sorted(found)


# Shapes. A token's shape is a number whose digits are the values of FEATURES.
_LENGTHS = (2, 3, 4, 6, 8, 12, 16, 20, 24, 32, 40)
FEATURES = {"length": 12, "kinds": 16, "hex": 2, "digits": 5, "changes": 5, "sign": 8, "trigger": 2}
_SIGNS = {"=": 1, ":": 2, '"': 3, "'": 4, ",": 5, "|": 6}


_LENGTH_OF = tuple(sum(n >= x for x in _LENGTHS) for n in range(41))


@lru_cache(maxsize=200_000)  # a limit on memory only
def shape(token: str) -> int:
    n = len(token)
    lowered = token.lower()
    digit = changes = 0
    if token.isalpha():
        other = False
    else:
        is_digit = "".join(["d" if "0" <= c <= "9" else "x" for c in token])
        digit = is_digit.count("d")
        changes = is_digit.count("dx") + is_digit.count("xd")
        other = not token.isalnum()
    values = (
        _LENGTH_OF[min(n, 40)],
        (token.upper() != token) + 2 * (lowered != token) + 4 * (digit > 0) + 8 * other,
        int(not token.strip("0123456789abcdef")),
        0 if not digit else 4 if digit == n else 1 + min(2, 3 * digit // n),
        min(4, changes if changes < 3 else 3 + (changes >= 6)),
        _SIGNS.get(token, 7 if n == 1 else 0),
        int(bool(_TRIGGER.search(lowered))),
    )
    code = 0
    for value, size in zip(values, FEATURES.values()):
        code = code * size + value
    return code


SHAPES = int(np.prod(list(FEATURES.values())))
_OFFSETS = np.cumsum([0, *FEATURES.values()])
ROLES = ("own", "before", "after")
FILE_FEATURES = 3  # a trigger word; an equals sign; over a twentieth of the tokens with digits
N_SHAPE = int(_OFFSETS[-1])


def _columns(codes: np.ndarray) -> np.ndarray:
    """Feature numbers of shapes, one column for each of FEATURES."""
    out, rest = [], codes.astype(np.int64)
    for size, offset in zip(reversed(list(FEATURES.values())), reversed(_OFFSETS[:-1].tolist())):
        out.append(rest % size + offset)
        rest = rest // size
    return np.stack(out[::-1], axis=1)


def likeness(codes: np.ndarray) -> np.ndarray:
    """How much shapes look like a secret, for the choice of windows without one: turns of letter and digit, and length."""
    values = _columns(codes) - _OFFSETS[:-1]
    return 16 * values[:, 4] + values[:, 0]


EDGE = -1  # what stands before the first and after the last token


def tokens_of(text: str) -> tuple[np.ndarray, int]:
    """Shapes of a text's tokens and its file features as bits."""
    words = TOKEN.findall(text)
    codes = np.fromiter(map(shape, words), np.int64, len(words))
    digits = int(((codes // (FEATURES["changes"] * FEATURES["sign"] * FEATURES["trigger"])) % FEATURES["digits"] > 0).sum())
    trigger = int((codes % FEATURES["trigger"]).any())
    return codes, trigger + 2 * ("=" in text) + 4 * (20 * digits > len(words))


class Field:
    """Weights: ``w`` for (role, feature, tag), ``f`` for (file feature, tag), ``t`` for (tag, next tag)."""

    def __init__(self):
        self.w = np.zeros((len(ROLES), N_SHAPE + 1, 3))
        self.f = np.zeros((FILE_FEATURES, 3))
        self.t = np.zeros((3, 3))
        self.bias = np.array([2.0, -1.0, -1.0])

    def tables(self, codes: np.ndarray) -> np.ndarray:
        """Scores of each shape in each role."""
        columns = _columns(codes)
        return self.w[:, columns].sum(axis=2)

    def file_scores(self, bits: np.ndarray) -> np.ndarray:
        has = (bits[:, None] >> np.arange(FILE_FEATURES)) & 1
        return has @ self.f + self.bias

    def scores(self, codes: np.ndarray, edges: np.ndarray, bits: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tag scores of concatenated texts; ``edges`` are the places where texts begin."""
        unique, place = np.unique(codes, return_inverse=True)
        own, before, after = self.tables(unique)
        out = own[place] + np.repeat(self.file_scores(bits), lengths, axis=0)
        edge = self.w[:, N_SHAPE]
        left, right = before[place[:-1]], after[place[1:]]
        out[1:] += left
        out[:-1] += right
        starts, ends = edges[lengths > 0], (edges + lengths - 1)[lengths > 0]
        inner = starts[starts > 0]
        out[inner] -= left[inner - 1]
        out[inner - 1] -= right[inner - 1]
        out[starts] += edge[1]
        out[ends] += edge[2]
        return out


_ALLOWED = np.zeros((3, 3))
_ALLOWED[O, I] = -1e9  # inside follows begin or inside only
_FIRST = np.array([1.0, 1.0, 0.0])  # no text begins inside


def viterbi(field: Field, codes: np.ndarray, bits: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best tags of concatenated texts. Texts run side by side, the longest first, so a step is one operation.

    Leaving tag O over a stretch gains at most the sum of (best other score - O's score + twice the best
    transition's lead over staying in O) over its tokens. A text in which no token has that above zero is all O.
    """
    starts = np.cumsum(lengths) - lengths
    tags = np.zeros(len(codes), np.int8)
    if not len(codes):
        return tags
    score = field.scores(codes, starts, bits, lengths)
    lead = 2 * max(0.0, field.t.max() - field.t[O, O])
    hopeful = np.maximum(score[:, B], score[:, I]) + lead >= score[:, O]
    counts = np.concatenate([[0], np.cumsum(hopeful)])
    order = np.flatnonzero(counts[starts + lengths] > counts[starts])
    if not len(order):
        return tags
    order = order[np.argsort(-lengths[order], kind="stable")]
    begin, size = starts[order], lengths[order]
    transition = field.t + _ALLOWED
    back = np.zeros((len(codes), 3), np.int8)
    live = int((size > 0).sum())
    v = score[begin[:live]].copy()
    v[:, I] -= 1e9
    best = np.zeros((len(order), 3))
    best[:live] = v
    steps = int(size[0])
    ending = np.searchsorted(-size, -np.arange(steps + 1), side="left")  # texts longer than t, for each t
    for t in range(1, steps):
        live = int(ending[t])
        ways = best[:live, :, None] + transition
        choice = ways.argmax(axis=1)
        at = begin[:live] + t
        back[at] = choice
        best[:live] = np.take_along_axis(ways, choice[:, None, :], axis=1)[:, 0] + score[at]
    tag = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        live = int(ending[t])
        at = begin[:live] + t
        tags[at] = tag[:live]
        tag[:live] = back[at, tag[:live]]
    return tags


def train(windows: list[tuple[list[int], list[int], int]], hidden: float = HIDDEN) -> Field:
    """Fit the field to ``(shapes, tags, file bits)`` by gradient steps on the mean log-likelihood.

    ``hidden`` is the share of cues that a window hides at a step; those it shows count the more.
    """
    field = Field()
    windows = [w for w in windows if w[0]]
    if not any(B in tags for _, tags, _ in windows):
        field.bias = np.array([50.0, 0.0, 0.0])
        return field
    n, width = len(windows), max(len(w[0]) for w in windows)
    lengths = np.array([len(w[0]) for w in windows])
    codes = np.full((n, width), -1, np.int64)
    gold = np.zeros((n, width), np.int64)
    for i, (c, g, _) in enumerate(windows):
        codes[i, :len(c)], gold[i, :len(c)] = c, g
    bits = np.array([w[2] for w in windows])
    inside = codes >= 0
    unique, place = np.unique(codes[inside], return_inverse=True)
    where = np.full(codes.shape, len(unique))  # the last is the edge
    where[inside] = place
    padded = np.pad(where, ((0, 0), (1, 1)), constant_values=len(unique))
    by_role = {0: where, 1: padded[:, :-2], 2: padded[:, 2:]}
    columns = _columns(unique)
    one = np.eye(3)
    has = (bits[:, None] >> np.arange(FILE_FEATURES)) & 1
    mean = 1.0 / n
    squares = [np.full_like(x, 1e-2) for x in (field.w, field.f, field.t, field.bias)]
    pairs = inside[:, 1:]
    seen = np.einsum("ntk,ntl->kl", one[gold[:, :-1]] * pairs[..., None], one[gold[:, 1:]])
    rng = np.random.default_rng(9)
    for _ in range(STEPS):
        shown = (rng.random((MASKS, len(ROLES), len(FEATURES))) >= hidden) / (1 - hidden)
        mask = rng.integers(0, MASKS, n)[:, None]
        shown_file = has * (rng.random(has.shape) >= hidden) / (1 - hidden)
        scores = (shown_file @ field.f + field.bias)[:, None, :].repeat(width, axis=1)
        for role in range(len(ROLES)):
            table_ = np.einsum("mc,uck->muk", shown[:, role], field.w[role][columns])
            edge = np.broadcast_to(field.w[role, N_SHAPE], (MASKS, 1, 3))  # is never hidden
            scores = scores + np.concatenate([table_, edge], axis=1)[mask, by_role[role]]
        # Forward and backward sums in units of their own, so that none runs out of range.
        step = np.exp(field.t + _ALLOWED - field.t.max())
        weight = np.exp(scores - scores.max(axis=2, keepdims=True))
        forward, backward = np.zeros((n, width, 3)), np.ones((n, width, 3))
        forward[:, 0] = weight[:, 0] * _FIRST
        for t in range(1, width):
            to = (forward[:, t - 1] @ step) * weight[:, t]
            forward[:, t] = to / to.sum(axis=1, keepdims=True)
        for t in range(width - 2, -1, -1):
            to = (backward[:, t + 1] * weight[:, t + 1]) @ step.T
            backward[:, t] = np.where(inside[:, t + 1, None], to / to.sum(axis=1, keepdims=True), 1.0)
        node = forward * backward
        node /= np.where(inside, node.sum(axis=2), 1.0)[..., None]
        ahead = (weight * backward)[:, 1:]
        both = ((forward[:, :-1] @ step) * ahead).sum(axis=2, keepdims=True)
        joint = np.einsum("ntk,ntl->kl", forward[:, :-1] * pairs[..., None] / both, ahead) * step
        rest = (one[gold] - node) * inside[..., None]
        grad_w = np.zeros_like(field.w)
        for role in range(len(ROLES)):
            flat = (mask * (len(unique) + 1) + by_role[role])[inside]
            sums = np.stack([np.bincount(flat, rest[inside][:, k], MASKS * (len(unique) + 1)) for k in range(3)], axis=1)
            sums = sums.reshape(MASKS, len(unique) + 1, 3)
            for c in range(columns.shape[1]):
                np.add.at(grad_w[role], columns[:, c], np.einsum("m,muk->uk", shown[:, role, c], sums[:, :-1]))
            grad_w[role, N_SHAPE] = sums[:, -1].sum(axis=0)
        grads = [grad_w, shown_file.T @ rest.sum(axis=1), seen - joint, rest.sum(axis=(0, 1))]
        for x, g, q in zip((field.w, field.f, field.t, field.bias), grads, squares):
            g = g * mean - 1e-4 * x
            q += g * g
            x += RATE * g / np.sqrt(q)
    return field


def another_secret(rng: np.random.Generator, alphabets: dict[str, str] = ALPHABETS) -> str:
    """A random string such as keys and access tokens are: 12 to 64 characters, digits and letters, in one of FORMS."""
    letters = list(alphabets[str(rng.choice(sorted(alphabets)))])
    while True:
        body = "".join(rng.choice(letters, int(rng.integers(12, 65))))
        if any(c.isdigit() for c in body) and any(c.isalpha() for c in body):
            break
    form = str(rng.choice(FORMS))
    if form == "prefix":
        return "".join(rng.choice(list("abcdefghikmnoprstx"), int(rng.integers(2, 5)))) + str(rng.choice(["_", "-"])) + body
    if form == "parts":
        cut = sorted(rng.choice(np.arange(4, len(body) - 3), 2).tolist())
        return str(rng.choice(["-", ".", "_"])).join([body[:cut[0]], body[cut[0]:cut[1]], body[cut[1]:]])
    return body + "=" * int(rng.integers(1, 3)) if form == "padded" else body


def _window(text: str, secrets: list[tuple[int, int]], digest: bytes) -> dict | None:
    """Shapes, tags and file features around a text's first secret, or around a place that ``digest`` names."""
    spans = [m.span() for m in TOKEN.finditer(text)]
    if not spans:
        return None
    codes, bits = tokens_of(text)
    tags, k = np.zeros(len(spans), np.int64), 0
    for i, (start, end) in enumerate(spans):
        while k < len(secrets) and secrets[k][1] <= start:
            k += 1
        if k < len(secrets) and secrets[k][0] < end:
            tags[i] = I if i and tags[i - 1] and spans[i - 1][1] > secrets[k][0] else B
    hits = np.flatnonzero(tags == B)
    if len(hits):
        middle = int(hits[0])
    elif digest[-2] % 2:
        middle = int(likeness(codes).argmax())
    else:
        middle = int.from_bytes(digest[:4], "big") % len(spans)
    lo = max(0, min(middle - WINDOW // 2, len(spans) - WINDOW))
    own = tags[lo:lo + WINDOW].tolist()
    if own[0] == I:
        own[0] = B
    return {"secret": bool(len(hits)), "rank": digest.hex(), "shapes": codes[lo:lo + WINDOW].tolist(), "tags": own,
            "bits": bits}


def with_others(text: str, secrets: list[tuple[int, int]], rng: np.random.Generator,
              alphabets: dict[str, str] = ALPHABETS) -> tuple[str, list[tuple[int, int]]]:
    """The text with another secret in each one's place, and where these are."""
    out, places, at, size = [], [], 0, 0
    for start, end in secrets:
        if start < at:  # inside the one before
            continue
        new = another_secret(rng, alphabets)
        out += [text[at:start], new]
        size += start - at
        places.append((size, size + len(new)))
        size += len(new)
        at = end
    return "".join([*out, text[at:]]), places


def with_one(text: str, rng: np.random.Generator,
              alphabets: dict[str, str] = ALPHABETS) -> tuple[str, list[tuple[int, int]]]:
    """The text with a secret put between two of its words, bare or in quotes, and where it is."""
    gaps = [m.end() for m in re.finditer(r"\s", text)] or [len(text)]
    at, quote, new = int(rng.choice(gaps)), str(rng.choice(["", "", '"', "'"])), another_secret(rng, alphabets)
    start = at + len(quote)
    return f"{text[:at]}{quote}{new}{quote} {text[at:]}", [(start, start + len(new))]


def _windows(batches: Iterator[pa.RecordBatch], alphabets: dict[str, str] = ALPHABETS) -> Iterator[pa.RecordBatch]:
    """Training windows of a sample; each document gives one as it is and one with another secret."""
    for batch in batches:
        out: list[dict] = []
        for text in texts_of(batch.column(0)):
            secrets = secret_parts(text)
            digest = hashlib.md5(text.encode(), usedforsecurity=False).digest()
            if not secrets and digest[-1] >= 32:  # one in eight of those without a secret will do
                continue
            rng = np.random.default_rng(list(digest))
            other = with_others(text, secrets, rng, alphabets) if secrets else with_one(text, rng, alphabets)
            ways = [(text, secrets, digest), (*other, hashlib.md5(digest, usedforsecurity=False).digest())]
            out += [w for way in ways if (w := _window(*way))]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
            [("secret", pa.bool_()), ("rank", pa.string()), ("shapes", pa.list_(pa.int64())),
             ("tags", pa.list_(pa.int64())), ("bits", pa.int64())]))


def fit(docs: DataFrame, text_column: str = "text", sample_rows: int = SAMPLE_ROWS,
        alphabets: dict[str, str] = ALPHABETS) -> Field:
    """Train on a bounded sample of the documents; ``alphabets`` are those of the secrets put into them."""
    rows = docs.count()
    sample = docs.select(F.col(text_column).cast("string").alias("text"))
    if rows > sample_rows:
        sample = sample.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * sample_rows / rows))
    windows = sample.dropDuplicates(["text"]).mapInArrow(
        partial(_windows, alphabets=alphabets), "secret boolean, rank string, shapes array<long>, tags array<long>, bits long")
    some = [windows.filter(F.col("secret") == flag).orderBy("rank").limit(TRAIN_WINDOWS) for flag in (True, False)]
    rows = [r for part in some for r in part.collect()]  # at most 2 * TRAIN_WINDOWS windows
    return train([(r["shapes"], r["tags"], r["bits"]) for r in rows])


def _added(text: str, tags: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    spans = [m.span() for m in TOKEN.finditer(text)]
    found: list[list[int]] = []
    for i in np.flatnonzero(tags).tolist():
        if tags[i] == I and found and found[-1][2] == i - 1:
            found[-1][1:] = [spans[i][1], i]
        else:
            found.append([spans[i][0], spans[i][1], i])
    clear = [(s, 3, e) for s, e, _ in found if not any(a < e and s < z for a, _, z in base)]
    return clear


def scan(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All spans of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, count in _parts(batch.column(1)):
                part = batch.slice(lo, count)
                texts = texts_of(part.column(1))
                seen = [tokens_of(t) for t in texts]
                lengths = np.array([len(c) for c, _ in seen])
                tags = viterbi(field, np.concatenate([c for c, _ in seen]), np.array([b for _, b in seen]), lengths)
                ends = np.cumsum(lengths)
                rows = []
                for key, text, end, size in zip(part.column(0).to_pylist(), texts, ends, lengths):
                    base, own = base_spans(text), tags[end - size:end]
                    extra = _added(text, own, base) if own.any() else []
                    shown = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
                    n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                    rows.append((key, *n, hashlib.sha256(shown(base).encode()).hexdigest(), shown(base + extra),
                                 len(extra)))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], [f.split()[0] for f in FOUND.split(", ")])

    narrow = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return narrow.mapInArrow(run, FOUND)


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of rows with a bounded number of characters, a longer text alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > lo and total + size > 4 * TOKENS_AT_ONCE:
            yield lo, i - lo
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes) - lo


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs))


QUERIES = {"op9_secret_scan": op9_secret_scan}
SQL: dict[str, str] = {}
