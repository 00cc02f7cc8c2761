"""Personal data: exact patterns first, then a linear-chain conditional random field.

The patterns find e-mail addresses, IPv4 addresses, card numbers and telephone
numbers with a plus sign. The random field adds forms that they miss: telephone
numbers without a plus sign, addresses outside ASCII or with a one-label domain,
card numbers with other signs between the groups, and IPv6 addresses. It reads
lines as sequences of blank-separated tokens, through their shapes and those of
their neighbours. A token without a digit and without ``@`` is always outside,
so a line falls apart into short runs, and the best path through a run is the
best path through the line. All runs of a slice are decoded together by length.

A null text has no spans. Repeated rows give repeated rows, null ids stand for
themselves, an empty table gives no rows, columns besides id and text are
ignored. Long texts are read in parts that end at a line end. Without a
labelled row the model adds nothing.
"""

from __future__ import annotations

import ipaddress
import random
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.support import chunks, text_column

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{edge}-{kind}" for kind in KINDS for edge in "BI"))
FEATURES = 1 << 13
# At most so many labelled rows are fitted; everything else covers all rows.
MAX_LABELLED = 2_000
STEPS = 120
NEVER = -1e4
_LINE_ENDS = b"\n\x0b\x0c\r"
_BLANKS = b" \t" + _LINE_ENDS
_SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def _flags(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_DIGITS = b"0123456789"
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_LABEL = _flags(_LETTERS + _DIGITS + b"-")
_LOCAL = _flags(_LETTERS + _DIGITS + b"._%+-")
_CALL = _flags(_DIGITS + b" ().-")
_DIGIT = _flags(_DIGITS)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _following(positions: np.ndarray, at: np.ndarray, none: int) -> np.ndarray:
    """The first of ``positions`` not before each ``at``."""
    return np.append(positions, none)[np.searchsorted(positions, at)]


def emails(data: np.ndarray) -> Iterator[tuple[int, int]]:
    signs = np.flatnonzero(data == 64)
    if not len(signs):
        return
    outside, no_local = np.flatnonzero(~_LABEL[data]), np.flatnonzero(~_LOCAL[data])
    ends = _following(outside, signs + 1, len(data))
    before = np.searchsorted(no_local, signs)
    lefts = np.where(before > 0, no_local[np.maximum(before, 1) - 1] + 1, 0)
    done = 0
    for sign, end, left in zip(signs.tolist(), ends.tolist(), lefts.tolist()):
        start, parts = max(left, done), 0
        if start >= sign or end == sign + 1:
            continue
        while end + 1 < len(data) and data[end] == 46 and _LABEL[data[end + 1]]:
            k = np.searchsorted(outside, end + 1)
            end, parts = (int(outside[k]) if k < len(outside) else len(data)), parts + 1
        if parts:
            yield start, end
            done = end


def addresses(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """IPv4: runs of digits joined by dots, four at a time."""
    if len(starts) < 4:
        return
    joined = (starts[1:] - ends[:-1] == 1) & (data[ends[:-1]] == 46)
    first = np.flatnonzero(np.concatenate([[True], ~joined]))
    chain = np.cumsum(np.concatenate([[True], ~joined])) - 1
    place = np.arange(len(starts)) - first[chain]
    size = np.diff(np.append(first, len(starts)))
    for at in np.flatnonzero((place % 4 == 0) & (place + 4 <= size[chain])).tolist():
        parts = [data[a:b].tobytes().lstrip(b"0") for a, b in zip(starts[at:at + 4].tolist(), ends[at:at + 4].tolist())]
        if all(len(p) < 3 or len(p) == 3 and int(p) <= 255 for p in parts):
            yield int(starts[at]), int(ends[at + 3])


def cards(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    if not len(starts):
        return
    sign = data[np.minimum(ends[:-1], len(data) - 1)]
    joined = (starts[1:] - ends[:-1] == 1) & ((sign == 32) | (sign == 45))
    first = np.flatnonzero(np.concatenate([[True], ~joined]))
    total = np.add.reduceat(ends - starts, first)
    last = np.append(first[1:], len(starts)) - 1
    fit = (total >= 13) & (total <= 19)
    for a, b in zip(starts[first[fit]].tolist(), ends[last[fit]].tolist()):
        own = data[a:b]
        if luhn(own[_DIGIT[own]].tobytes().decode()):
            yield a, b


def phones(data: np.ndarray) -> Iterator[tuple[int, int]]:
    plus = np.flatnonzero(data[:-1] == 43)
    plus = plus[_DIGIT[data[plus + 1]]]
    if not len(plus):
        return
    digits = np.flatnonzero(_DIGIT[data])
    stop = _following(np.flatnonzero(~_CALL[data]), plus + 1, len(data))
    upto = np.searchsorted(digits, stop)
    count = upto - np.searchsorted(digits, plus)
    last = digits[upto - 1]
    fit = (last >= plus + 3) & (count >= 9) & (count <= 15)
    yield from zip(plus[fit].tolist(), (last[fit] + 1).tolist())


def base_spans(data: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in bytes of all pattern matches; texts are apart by a line end."""
    starts, ends = _runs(_DIGIT[data])
    found = (emails(data), addresses(data, starts, ends), cards(data, starts, ends), phones(data))
    return [(kind, a, b) for kind, spans in enumerate(found) for a, b in spans]


# --- the random field

def shape(token: str) -> str:
    """Letters as x or X, digits as d, each run as its first sign and its length up to four; signs stay."""
    out, last, count = [], "", 0
    for c in token[:64]:
        kind = "d" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c
        if kind != last:
            if last in ("d", "x", "X"):
                out.append(str(min(count, 4)))
            out.append(kind)
            last, count = kind, 0
        count += 1
    if last in ("d", "x", "X"):
        out.append(str(min(count, 4)))
    return "".join(out)


def core(token: str) -> tuple[int, int]:
    """Where a token's letters and digits begin and end."""
    begin, end = 0, len(token)
    while begin < end and not token[begin].isalnum():
        begin += 1
    while end > begin and not token[end - 1].isalnum():
        end -= 1
    return begin, end


def features(before: str, tokens: list[str], after: str) -> np.ndarray:
    """Feature numbers of each token of a run; ``before`` and ``after`` are its neighbours in the line."""
    trimmed = [t[slice(*core(t))] for t in tokens]
    shapes = ["^" + shape(before[-24:]), *(shape(t) for t in trimmed), "$" + shape(after[:24])]
    rows = []
    for k, (token, own) in enumerate(zip(tokens, trimmed)):
        digits = sum("0" <= c <= "9" for c in own[:64])
        signs = "".join(sorted({c for c in own[:64] if not c.isalnum()}))
        word = before.strip("#*:;.,=\"'()").lower()[:24] if k == 0 else ""
        rows.append([zlib.crc32(f.encode()) % FEATURES for f in (
            f"s{shapes[k + 1]}", f"p{shapes[k]}|{shapes[k + 1]}", f"n{shapes[k + 1]}|{shapes[k + 2]}", f"w{word}", f"d{min(digits, 20)}",
            f"g{signs}", f"o{token[:1] if not token[:1].isalnum() else ''}|{len(own) == digits}",
            f"c{13 <= digits <= 19 and digits == sum(c.isdigit() for c in own) and luhn(''.join(c for c in own if '0' <= c <= '9'))}"
            f"|{'@' in own}|{own.count(':') > 1}", "b")])
    return np.array(rows, np.int64)


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Scores that forbid an inside label at the start or behind another kind."""
    n = len(LABELS)
    start, step = np.zeros(n), np.zeros((n, n))
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            start[j] = NEVER
            for i, other in enumerate(LABELS):
                if other[2:] != label[2:] or other == "O":
                    step[i, j] = NEVER
    return start, step


class Field:
    """Weights of a linear-chain conditional random field over ``LABELS``."""

    def __init__(self, weights: np.ndarray, start: np.ndarray, step: np.ndarray):
        fixed_start, fixed_step = _allowed()
        self.weights, self.start, self.step = weights, start + fixed_start, step + fixed_step

    def decode(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each run of feature rows (Viterbi), runs of one length together."""
        by_length, out = defaultdict(list), [None] * len(runs)
        for k, run in enumerate(runs):
            by_length[len(run)].append(k)
        for length, members in by_length.items():
            for at in range(0, len(members), 4_096):
                own = members[at:at + 4_096]
                emit = self.weights[np.stack([runs[k] for k in own])].sum(2) if length < 4_096 else np.concatenate(
                    [self.weights[runs[own[0]][i:i + 4_096]].sum(1) for i in range(0, length, 4_096)])[None]
                if length >= 4_096:
                    for k in own[1:]:
                        out[k] = self.decode([runs[k]])[0]
                    own = own[:1]
                best = self.start + emit[:, 0]
                back = np.zeros((len(own), length, len(LABELS)), np.int8)
                for t in range(1, length):
                    ways = best[:, :, None] + self.step
                    back[:, t] = ways.argmax(1)
                    best = ways.max(1) + emit[:, t]
                path = np.zeros((len(own), length), np.int8)
                path[:, -1] = best.argmax(1)
                for t in range(length - 1, 0, -1):
                    path[:, t - 1] = back[np.arange(len(own)), t, path[:, t]]
                for k, labels in zip(own, path):
                    out[k] = labels
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def train(runs: list[np.ndarray], labels: list[np.ndarray], steps: int = STEPS, penalty: float = 1e-4) -> Field:
    """Weights of largest penalised likelihood, by adaptive gradient steps over all runs at once."""
    n = len(LABELS)
    weights, start, step = np.zeros((FEATURES, n)), np.zeros(n), np.zeros((n, n))
    if not runs:
        weights[:, 0] = 1.0
        return Field(weights, start, step)
    length, width = max(map(len, runs)), runs[0].shape[1]
    ids, gold = np.zeros((len(runs), length, width), np.int64), np.zeros((len(runs), length), np.int64)
    live = np.zeros((len(runs), length), bool)
    for k, (run, own) in enumerate(zip(runs, labels)):
        ids[k, :len(run)], gold[k, :len(run)], live[k, :len(run)] = run, own, True
    fixed_start, fixed_step = _allowed()
    flat = ids[live]
    want = np.eye(n)[gold]
    moved = live[:, 1:, None, None] * want[:, :-1, :, None] * want[:, 1:, None, :]
    slopes = [[np.zeros_like(w), np.zeros_like(w)] for w in (weights, start, step)]
    for turn in range(1, steps + 1):
        emit = np.zeros((len(runs), length, n))
        emit[live] = weights[flat].sum(1)
        way = step + fixed_step
        ahead = np.zeros_like(emit)
        ahead[:, 0] = start + fixed_start + emit[:, 0]
        for t in range(1, length):
            ahead[:, t] = np.where(live[:, t, None], _log_sum(ahead[:, t - 1, :, None] + way, 1) + emit[:, t], ahead[:, t - 1])
        total = _log_sum(ahead[:, -1], 1)
        behind = np.zeros_like(emit)
        for t in range(length - 2, -1, -1):
            behind[:, t] = np.where(live[:, t + 1, None], _log_sum((behind[:, t + 1] + emit[:, t + 1])[:, None, :] + way, 2), 0)
        node = np.exp(ahead + behind - total[:, None, None])
        pair = np.exp(ahead[:, :-1, :, None] + way + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None])
        off = (node - want)[live]
        slope_w = np.zeros_like(weights)
        for column in range(width):
            np.add.at(slope_w, flat[:, column], off)
        slope = (slope_w / len(runs) + penalty * weights, (node[:, 0] - want[:, 0]).mean(0),
                 (pair * live[:, 1:, None, None] - moved).sum((0, 1)) / len(runs))
        for w, g, (m, v) in zip((weights, start, step), slope, slopes):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= 0.15 * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8)
    return Field(weights, start, step)


def soft_runs(text: str) -> Iterator[tuple[str, list[str], list[int], str]]:
    """(token before, tokens, their places, token behind) of each run of tokens with a digit or ``@`` in a line."""
    at = 0
    for line in text.replace("\x0b", "\n").replace("\x0c", "\n").replace("\r", "\n").split("\n"):
        tokens, places, begin = [], [], at
        for token in line.replace("\t", " ").split(" "):
            if token:
                tokens.append(token)
                places.append(begin)
            begin += len(token) + 1
        at += len(line) + 1
        k = 0
        while k < len(tokens):
            end = k
            while end < len(tokens) and any(c == "@" or "0" <= c <= "9" for c in tokens[end]):
                end += 1
            if end > k:
                yield (tokens[k - 1] if k else ""), tokens[k:end], places[k:end], (tokens[end] if end < len(tokens) else "")
            k = end + 1


def fit(labelled: DataFrame, limit: int = MAX_LABELLED) -> Field:
    """The model of at most ``limit`` labelled rows: text, spans array<struct<kind,start,end>> in code points."""
    runs, labels = [], []
    for row in labelled.orderBy(F.xxhash64("text"), "text").limit(limit).collect():
        spans = [(s["start"], s["end"], s["kind"]) for s in row["spans"] or [] if s["kind"] in KINDS]
        for before, tokens, places, after in soft_runs(row["text"] or ""):
            own, last = [], None
            for token, place in zip(tokens, places):
                hit = next((s for s in spans if s[0] < place + len(token) and s[1] > place), None)
                own.append(0 if hit is None else LABELS.index(("I-" if hit == last else "B-") + hit[2]))
                last = hit
            runs.append(features(before, tokens, after))
            labels.append(np.array(own))
    return train(runs, labels)


def _valid(kind: str, text: str) -> bool:
    digits = [c for c in text if "0" <= c <= "9"]
    if kind == "email":
        return "@" in text.strip("@")
    if kind == "ip":
        try:
            return ipaddress.ip_address(text).version == 6
        except ValueError:
            return False
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn("".join(digits))
    return 9 <= len(digits) <= 15


def _sequences(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of the lines that hold a digit or ``@``."""
    soft = np.flatnonzero(_DIGIT[data] | (data == 64))
    if len(soft):
        breaks = np.concatenate([[-1], np.flatnonzero(_flags(_LINE_ENDS)[data]), [len(data)]])
        lines = np.unique(np.searchsorted(breaks, soft))
        yield from zip((breaks[lines - 1] + 1).tolist(), breaks[lines].tolist())


def added_spans(data: np.ndarray, model: Field) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in bytes of what the random field finds."""
    runs, where = [], []
    for a, b in _sequences(data):
        line = data[a:b].tobytes().decode()
        for before, tokens, places, after in soft_runs(line):
            runs.append(features(before, tokens, after))
            where.append((a, line, tokens, places))
    out = []
    for (a, line, tokens, places), labels in zip(where, model.decode(runs)):
        k = 0
        while k < len(labels):
            end = k + 1
            if labels[k]:
                kind = LABELS[labels[k]][2:]
                while end < len(labels) and LABELS[labels[end]] == f"I-{kind}":
                    end += 1
                begin = places[k] + core(tokens[k])[0]
                stop = places[end - 1] + core(tokens[end - 1])[1]
                if kind == "phone" and begin > places[k] and line[begin - 1] in "(+":
                    begin -= 1
                if begin < stop and _valid(kind, line[begin:stop]):
                    first = a + len(line[:begin].encode())
                    out.append((KINDS.index(kind), first, first + len(line[begin:stop].encode())))
            k = end
    return out


def find(documents: DataFrame, model: Field, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and the spans of each text: kind, start and end in code points, and whether a pattern found it."""

    def part_spans(data: np.ndarray) -> list[tuple[int, int, int, bool]]:
        base = base_spans(data)
        taken = np.zeros(len(data) + 1, np.int32)
        for _, a, b in base:
            taken[a] += 1
            taken[b] -= 1
        held = np.concatenate([[0], np.cumsum(np.cumsum(taken[:-1]) > 0)])
        return [(*s, True) for s in base] + [(*s, False) for s in added_spans(data, model) if held[s[2]] == held[s[1]]]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found, passed = [[] for _ in range(batch.num_rows)], 0
            for data, offsets, rows, goes_on in chunks(batch.column(1), _flags(_LINE_ENDS)):
                # a line end between texts keeps every match inside its own
                data = np.insert(data, offsets[1:-1], 10)
                starts = offsets[:-1] + np.arange(len(rows))
                upto = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                passed = passed if goes_on else 0
                for kind, a, b, base in part_spans(data):
                    k = int(np.searchsorted(starts, a, "right")) - 1
                    shift = passed - int(upto[starts[k]])
                    found[rows[k]].append((kind, int(upto[a]) + shift, int(upto[b]) + shift, base))
                passed += int(upto[-1])
            spans = [[{"kind": KINDS[kind], "start": a, "end": b, "base": base} for kind, a, b, base in sorted(own)]
                     for own in found]
            yield pa.record_batch([batch.column(0), pa.array(spans, pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])))],
                names=["doc_id", "spans"])

    return (documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_column(documents, text).alias("text"))
            .mapInArrow(run, f"doc_id long, spans {_SPANS}"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, pattern matches by kind, their SHA-256, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind)))
    return found.select(
        "doc_id", *(count(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


# --- the labelled table

def labelled_lines(spark: SparkSession, rows: int = 1_600, seed: int = 7) -> DataFrame:
    """text, spans: short invented lines with personal data in the forms to learn, and numbers that are none."""
    rng = random.Random(seed)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice(("an", "er", "the", "lo", "si", "éa", "ü", "ch", "ti", "os")) for _ in range(rng.randrange(1, 5)))

    def card(valid: bool) -> str:
        while luhn(digits := number(16)) != valid:
            pass
        return digits

    def person() -> str:
        return rng.choice((word() + "." + word(), word() + number(2), word()))

    grouped = lambda digits, sign: sign.join(digits[i:i + 4] for i in range(0, 16, 4))
    given = {
        "phone": (lambda: f"({number(3)}) {number(3)}-{number(4)}", lambda: f"{number(3)}-{number(3)}-{number(4)}",
                  lambda: f"{number(3)}.{number(3)}.{number(4)}", lambda: f"00{number(2)} {number(3)} {number(6)}",
                  lambda: f"+{number(2)} {number(3)} {number(3)} {number(4)}", lambda: f"+1 ({number(3)}) {number(3)}-{number(4)}"),
        "email": (lambda: f"{person()}@{word()}", lambda: f"jö{word()}@mü{word()}.de", lambda: f"{person()}@{word()}.com"),
        "card": (lambda: grouped(card(True), rng.choice("./_")), lambda: grouped(card(True), rng.choice(" -")), lambda: card(True)),
        "ip": (lambda: ":".join(f"{rng.randrange(1, 1 << 16):x}" for _ in range(8)), lambda: f"2001:db8::{number(3)}",
               lambda: ".".join(str(rng.randrange(256)) for _ in range(4))),
    }
    other = (lambda: number(rng.randrange(1, 13)), lambda: f"20{number(2)}-0{rng.randrange(1, 9)}-1{number(1)}",
             lambda: f"1{number(1)}.0{number(1)}.20{number(2)}", lambda: f"1{number(1)}:{number(2)}", lambda: f"{number(1)}.{number(2)}",
             lambda: f"v{number(1)}.{number(1)}.{number(2)}", lambda: f"20{number(2)}-20{number(2)}", lambda: f"978-3-{number(2)}-{number(6)}-{number(1)}",
             lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((8, 32, 40)))), lambda: card(False),
             lambda: f"${number(2)}.{number(2)}", lambda: f"{number(1)},{number(3)}", lambda: word() + number(1), lambda: "@" + word(),
             lambda: f"{number(2)}%", lambda: "@", lambda: f"{number(3)} {number(3)} {number(3)}", lambda: f"{number(2)}/{number(2)}")
    cues = {"phone": ("tel", "call", "Phone:", "fax"), "email": ("mail", "write", "Contact:"), "card": ("card", "visa", "Karte"),
            "ip": ("host", "server", "from")}
    found = []
    for _ in range(rows):
        text, spans = "", []
        for _ in range(rng.randrange(2, 7)):
            pick = rng.random()
            if pick < 0.3:
                kind = rng.choice(KINDS)
                if rng.random() < 0.4:
                    text += rng.choice(cues[kind]) + " "
                value = rng.choice(given[kind])()
                spans.append((kind, len(text), len(text) + len(value)))
                text += value + rng.choice(("", "", ".", ",", "###", "&&&", "%%%"))
            else:
                text += rng.choice(other)() if pick < 0.65 else word()
                text += rng.choice(("", "", ",", ".", "***", "$$$"))
            text += rng.choice((" ", " ", " ", "\n")) + word() + " "
        found.append((text, spans))
    return spark.createDataFrame(found, "text string, spans array<struct<kind:string,start:long,end:long>>")
