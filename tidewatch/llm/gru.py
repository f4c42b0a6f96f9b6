"""A bidirectional gated recurrent network with attention pooling, trained and run in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words of a window and words between the starts of two windows.
WINDOW, STRIDE = 16, 8
#: Hashed rows of the word and of the character table, and numbers in a row.
WORD_ROWS, CHAR_ROWS, WIDTH = 1 << 15, 1 << 16, 8
#: State of one direction.
HIDDEN = 8
TRIM = b".,!?;:|#$%&*()\"'"


def tidy(text: str) -> list[bytes]:
    """Lower-cased words without punctuation around them; a word of punctuation alone stays."""
    return [word.strip(TRIM) or word for word in text.lower().encode("utf-8", "surrogatepass").split()]


def char_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the character table for each word: runs of four bytes and prefixes of up to eight; and whose they are."""
    owners, rows = [], []
    lengths = np.array([len(word) for word in words])
    widths = 1 << np.maximum(4, np.ceil(np.log2(np.maximum(lengths + 1, 1))).astype(int))
    for width in np.unique(widths):
        mine = np.flatnonzero(widths == width)
        flat = b"".join(b"\x01" + words[i].ljust(width - 1, b"\0") for i in mine)
        table = np.frombuffer(flat, np.uint8).reshape(len(mine), width).astype(np.uint64)
        runs = (
            table[:, :-3] * np.uint64(0x9E3779B1) + table[:, 1:-2] * np.uint64(0x85EBCA77)
            + table[:, 2:-1] * np.uint64(0xC2B2AE3D) + table[:, 3:] * np.uint64(0x27D4EB2F)
        )
        valid = np.arange(width - 3)[None, :] + 4 <= np.maximum(lengths[mine] + 1, 4)[:, None]
        prefix = np.zeros((len(mine), 5), dtype=np.uint64)
        total = np.zeros(len(mine), dtype=np.uint64)
        for k in range(9):
            total = total * np.uint64(0x100000001B3) + table[:, k] + np.uint64(1)
            if k >= 4:
                prefix[:, k - 4] = total
        reach = np.arange(4, 9)[None, :] <= lengths[mine][:, None]
        for values, flags in ((runs, valid), (prefix, reach)):
            values = values * np.uint64(0x9E3779B97F4A7C15)
            values = (values >> np.uint64(40)) % np.uint64(CHAR_ROWS)
            at = np.nonzero(flags)
            owners.append(mine[at[0]])
            rows.append(values[at].astype(np.int64))
    return np.concatenate(owners) if owners else np.zeros(0, int), np.concatenate(rows) if rows else np.zeros(0, int)


def word_row(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) % WORD_ROWS


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def windows(n: int) -> np.ndarray:
    """Starts of the overlapping windows over ``n`` words; each word lies in one at least."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)


class Network:
    """Word and character inputs, one GRU each way, attention over the words of a window, one output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        h, d = HIDDEN, 2 * WIDTH

        def some(*shape, scale=0.3):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "word": some(WORD_ROWS, WIDTH, scale=0.01), "char": some(CHAR_ROWS, WIDTH, scale=0.01),
            "w": some(d, 6 * h), "c": np.zeros(6 * h, np.float32),
            "u": some(2, h, 3 * h), "v": some(2 * h), "o": some(2 * h), "b": np.zeros(1, np.float32),
        }

    # ---------------------------------------------------------------- words

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        """The input of each word: its row of the word table, and the mean of its rows of the character table."""
        rows = np.array([word_row(word) for word in words], dtype=np.int64)
        owners, chars = char_rows(words)
        count = np.maximum(np.bincount(owners, minlength=len(words)), 1).astype(np.float32)
        order = np.argsort(owners, kind="stable")
        owners, chars = owners[order], chars[order]
        mean = np.zeros((len(words), WIDTH), np.float32)
        have = np.flatnonzero(np.bincount(owners, minlength=len(words)))
        if len(have):
            first = np.searchsorted(owners, have)
            mean[have] = np.add.reduceat(self.p["char"][chars], first, axis=0)
        mean /= np.sqrt(count)[:, None]
        return np.concatenate([self.p["word"][rows], mean], axis=1), (rows, owners, chars, count)

    def project(self, x: np.ndarray) -> np.ndarray:
        return x @ self.p["w"] + self.p["c"]

    # ---------------------------------------------------------------- windows

    def forward(self, g: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Outputs of windows from their projected words ``g`` (windows, WINDOW, 6 * HIDDEN) and mask."""
        n, steps, h = len(g), g.shape[1], HIDDEN
        state = np.zeros((2, steps, n, h), np.float32)
        saved = []
        for way in (0, 1):
            now = np.zeros((n, h), np.float32)
            u = self.p["u"][way]
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                x = g[:, t, 3 * h * way : 3 * h * (way + 1)]
                r = now @ u
                gates = sigmoid(x[:, : 2 * h] + r[:, : 2 * h])
                new = np.tanh(x[:, 2 * h :] + gates[:, h:] * r[:, 2 * h :])
                after = new + gates[:, :h] * (now - new)
                m = mask[:, t, None]
                after = now + m * (after - now)
                if keep:
                    saved.append((now, r, gates, new, m))
                state[way, t] = now = after
        joined = np.concatenate([state[0], state[1]], axis=2)
        score = joined @ self.p["v"]
        score = np.where(mask.T > 0, score, -1e9)
        weight = np.exp(score - score.max(0))
        weight = weight * mask.T
        weight /= np.maximum(weight.sum(0), 1e-9)
        context = (weight[:, :, None] * joined).sum(0)
        out = context @ self.p["o"] + self.p["b"][0]
        return (out, (saved, joined, weight, context)) if keep else out

    def backward(self, g: np.ndarray, mask: np.ndarray, kept: tuple, slope: np.ndarray) -> tuple[np.ndarray, dict]:
        """Gradients for ``slope``, the derivative of the loss by each output."""
        saved, joined, weight, context = kept
        n, steps, h = len(g), g.shape[1], HIDDEN
        grad = {"o": context.T @ slope, "b": np.array([slope.sum()], np.float32), "u": np.zeros_like(self.p["u"])}
        d_context = slope[:, None] * self.p["o"]
        d_weight = (joined * d_context).sum(2)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        grad["v"] = np.einsum("tn,tnk->k", d_score, joined)
        d_joined = weight[:, :, None] * d_context + d_score[:, :, None] * self.p["v"]
        d_g = np.zeros_like(g)
        for way in (0, 1):
            u, later = self.p["u"][way], np.zeros((n, h), np.float32)
            order = range(steps) if way == 0 else range(steps - 1, -1, -1)
            for place, t in reversed(list(enumerate(order))):
                now, r, gates, new, m = saved[way * steps + place]
                d = d_joined[t, :, h * way : h * (way + 1)] + later
                inner = m * d
                z, reset = gates[:, :h], gates[:, h:]
                d_new = inner * (1 - z) * (1 - new**2)
                d_z = inner * (now - new) * z * (1 - z)
                d_reset = d_new * r[:, 2 * h :] * reset * (1 - reset)
                d_r = np.concatenate([d_z, d_reset, d_new * reset], axis=1)
                d_g[:, t, 3 * h * way : 3 * h * (way + 1)] = np.concatenate([d_z, d_reset, d_new], axis=1)
                grad["u"][way] += now.T @ d_r
                later = (1 - m) * d + inner * z + d_r @ u.T
        return d_g, grad


class Scorer:
    """Runs a trained network over whole texts; remembers projected words up to a bound."""

    def __init__(self, network: Network, scale: tuple[float, float] = (1.0, 0.0), remember: int = 250_000):
        self.network, self.scale, self.remember = network, scale, remember
        self.place: dict[bytes, int] = {}
        self.table = np.zeros((1024, 6 * HIDDEN), np.float32)

    def _places(self, words: list[list[bytes]]) -> list[np.ndarray]:
        new = set().union(*words).difference(self.place)
        if len(self.place) + len(new) > self.remember:
            self.place = {}
            new = set().union(*words)
        if new:
            ordered, begin = list(new), len(self.place)
            self.place.update(zip(ordered, range(begin, begin + len(ordered)), strict=True))
            if len(self.place) > len(self.table):
                grown = np.zeros((2 * len(self.place), 6 * HIDDEN), np.float32)
                grown[:begin] = self.table[:begin]
                self.table = grown
            for k in range(0, len(ordered), 20_000):
                part = ordered[k : k + 20_000]
                self.table[begin + k : begin + k + len(part)] = self.network.project(self.network.inputs(part)[0])
        get = self.place.__getitem__
        return [np.fromiter(map(get, own), dtype=np.int64, count=len(own)) for own in words]

    def window_outputs(self, texts: list[str], block: int = 4096) -> list[np.ndarray]:
        """Outputs of all overlapping windows of each text; an empty text has one window without words."""
        rows = self._places([tidy(text) for text in texts])
        starts = [windows(len(own)) for own in rows]
        flat = np.concatenate([*rows, np.zeros(WINDOW, dtype=np.int64)])
        begin = np.cumsum([0, *(len(own) for own in rows)])
        first = np.concatenate([begin[i] + own for i, own in enumerate(starts)])
        limit = np.repeat(begin[1:], [len(own) for own in starts])
        out = np.zeros(len(first), np.float32)
        span = np.arange(WINDOW)
        for k in range(0, len(first), block):
            at = first[k : k + block, None] + span
            mask = (at < limit[k : k + block, None]).astype(np.float32)
            out[k : k + block] = self.network.forward(self.table[flat[np.minimum(at, len(flat) - 1)]], mask)
        return np.split(out, np.cumsum([len(own) for own in starts])[:-1])

    def scores(self, texts: list[str]) -> np.ndarray:
        """The probability that a text's strongest window gives it."""
        strongest = np.array([out.max() for out in self.window_outputs(texts)])
        return sigmoid(self.scale[0] * strongest + self.scale[1]).astype(float)


def _first_guess(network: Network, docs: list[list[bytes]], y: np.ndarray) -> None:
    """Puts how much a word, or a character row, points to label 1 into the first number of its row."""
    for table, size in (("word", WORD_ROWS), ("char", CHAR_ROWS)):
        counts = np.zeros((2, size))
        for words, label in zip(docs, y, strict=True):
            own = list(set(words))
            rows = np.array([word_row(word) for word in own], dtype=np.int64) if table == "word" else char_rows(own)[1]
            counts[int(label), np.unique(rows)] += 1
        n = np.bincount(y.astype(int), minlength=2)
        odds = np.log((counts[1] + 0.5) / (n[1] + 1)) - np.log((counts[0] + 0.5) / (n[0] + 1))
        odds[counts.sum(0) < 4] = 0
        network.p[table][:, 0] = (odds / 2).astype(np.float32)


def train(texts: list[str], labels: list[int], rounds: int = 3, epochs: int = 3, rate: float = 0.01, seed: int = 7) -> Scorer:
    """Trains on documents whose labels hold for their strongest window.

    In each round the windows are picked anew: the strongest two of each document with label 1, the strongest two and
    two others of each with label 0. Then Adam runs over them. At the end a line is fitted that turns a
    document's strongest output into a probability. With one class, or no rows, every text gets the share of label 1 (one half).
    """
    y = np.array(labels, dtype=np.float32)
    network, rng = Network(seed), np.random.default_rng(seed)
    if not len(y) or y.min() == y.max():
        share = (float(y.sum()) + 0.5) / (len(y) + 1) if len(y) else 0.5
        return Scorer(network, (0.0, float(np.log(share / (1 - share)))))
    docs = [tidy(text) for text in texts]
    _first_guess(network, docs, y)
    place: dict[bytes, int] = {}
    rows = [np.array([place.setdefault(word, len(place)) for word in words], dtype=np.int32) for words in docs]
    vocabulary = list(place) or [b""]
    del docs

    def scored() -> list[np.ndarray]:
        runner = Scorer(network)
        return [out for k in range(0, len(texts), 100) for out in runner.window_outputs(texts[k : k + 100])]

    moments = {name: (np.zeros_like(value), np.zeros_like(value)) for name, value in network.p.items()}
    step = 0
    for turn in range(rounds):
        if turn:
            outputs = scored()
        else:
            parts = [network.inputs(vocabulary[k : k + 20_000])[0] for k in range(0, len(vocabulary), 20_000)]
            hint = np.concatenate([part[:, 0] + part[:, WIDTH] for part in parts])
            del parts
            outputs = [
                np.array([hint[own[s : s + WINDOW]].max(initial=-9.0) for s in windows(len(own))], np.float32) for own in rows
            ]
        picks = []
        for i, out in enumerate(outputs):
            best = np.argsort(-out)[:2]
            picks += [(i, k) for k in best[: 1 + (turn == 0 and len(out) > 1)]]
            if not y[i]:
                picks += [(i, k) for k in rng.integers(0, len(out), 2)]
                picks += [(i, k) for k in best[1:]]
        picks = np.array(picks)
        weight_one = max(1.0, float((y[picks[:, 0]] == 0).sum() / max(1, (y[picks[:, 0]] == 1).sum())) / 2)
        for _ in range(epochs):
            order = rng.permutation(len(picks))
            for k in range(0, len(order), 256):
                part = picks[order[k : k + 256]]
                at = np.zeros((len(part), WINDOW), dtype=np.int64)
                mask = np.zeros((len(part), WINDOW), np.float32)
                for j, (i, window) in enumerate(part):
                    own = rows[i][window * STRIDE : window * STRIDE + WINDOW]
                    at[j, : len(own)], mask[j, : len(own)] = own, 1
                used, local = np.unique(at, return_inverse=True)
                x, (word_rows, owners, chars, count) = network.inputs([vocabulary[i] for i in used])
                local = local.reshape(at.shape)
                g = network.project(x)[local]
                out, kept = network.forward(g, mask, keep=True)
                target = y[part[:, 0]]
                slope = ((sigmoid(out) - target) * np.where(target == 1, weight_one, 1.0) / len(part)).astype(np.float32)
                d_g, grad = network.backward(g, mask, kept, slope)
                d_project = np.zeros((len(used), 6 * HIDDEN), np.float32)
                np.add.at(d_project, local.ravel(), d_g.reshape(-1, 6 * HIDDEN))
                grad["w"], grad["c"] = x.T @ d_project, d_project.sum(0)
                d_x = d_project @ network.p["w"].T
                touched = {}
                for name, target_rows, values in (
                    ("word", word_rows, d_x[:, :WIDTH]),
                    ("char", chars, (d_x[:, WIDTH:] / np.sqrt(count)[:, None])[owners]),
                ):
                    unique, where = np.unique(target_rows, return_inverse=True)
                    total = np.zeros((len(unique), WIDTH), np.float32)
                    np.add.at(total, where, values)
                    touched[name], grad[name] = unique, total
                step += 1
                for name, value in grad.items():
                    rows_of = touched.get(name, slice(None))
                    first, second = moments[name]
                    first[rows_of] = 0.9 * first[rows_of] + 0.1 * value
                    second[rows_of] = 0.99 * second[rows_of] + 0.01 * value**2
                    correction = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    network.p[name][rows_of] -= rate * correction * first[rows_of] / (np.sqrt(second[rows_of]) + 1e-6)
    strongest = np.array([out.max() for out in scored()], dtype=float)
    a, b = 1.0, 0.0
    for _ in range(200):  # a short logistic regression on one number
        p = sigmoid(a * strongest + b)
        w = np.maximum(p * (1 - p), 1e-4)
        gradient = np.array([((p - y) * strongest).sum() + 0.1 * (a - 1), (p - y).sum()])
        curve = np.array([[(w * strongest**2).sum() + 0.1, (w * strongest).sum()], [(w * strongest).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(curve, gradient)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    return Scorer(network, (float(max(a, 0.0)), float(b)))
