"""A gap-weighted subsequence kernel on short strings, its Nyström map and a linear support vector machine.

A string's features are its subsequences of four characters, each occurrence
weighted DECAY^span, with up to GAP - 1 characters skipped between neighbours.
Start and end are characters too. Letters are read without accents. Strings are scaled by the norm they would have
if no subsequence came twice, which depends on the length alone, so the scaled
kernel stays positive semidefinite.

A machine over Nyström features of landmarks is linear in the kernel values with
the landmarks, hence linear in the subsequence features: training ends with one
weight per subsequence, and scoring is a table lookup per occurrence.
"""

from __future__ import annotations

import itertools
import unicodedata

import numpy as np

ALPHABET = 32
TAKEN = 4
DECAY = 0.7
GAP = 2
PIECE = 24  # longer strings are scored over pieces of this length that overlap by half
PAD, START, END, OTHER = 0, 1, 2, 3

# Digits and signs that commonly stand for a letter.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for place, letter in enumerate("abcdefghijklmnopqrstuvwxyz"):
        table[ord(letter)] = 4 + place
    for code in range(0xC0, 0x3000):
        base = unicodedata.normalize("NFD", chr(code))[0]
        table[code] = table[ord(base)] if "a" <= base <= "z" else 30 + code % 2
    for sign, letter in LOOKALIKES.items():
        table[ord(sign)] = table[ord(letter)]
    return table


CLASSES = _classes()
STEPS = list(itertools.product(range(1, GAP + 1), repeat=TAKEN - 1))


def encoded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes with start and end, padded to one width, and the lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    width = int(lengths.max(initial=0))
    padded = "".join(w.ljust(width, "\0") for w in words)
    codes = np.zeros((len(words), width + 2), np.int32)
    if width:
        codes[:, 1:-1] = CLASSES[np.frombuffer(padded.encode("utf-32-le"), np.uint32)].reshape(len(words), width)
    codes[:, 1:-1][np.arange(width)[None, :] >= lengths[:, None]] = PAD
    codes[:, 0] = START
    codes[np.arange(len(words)), lengths + 1] = END
    return codes, lengths


def occurrences(codes: np.ndarray):
    """For each choice of steps: subsequence numbers (strings x places, 0 where one runs over the end) and their weight."""
    for steps in STEPS:
        places = codes.shape[1] - sum(steps)
        if places > 0:
            numbers, at = codes[:, :places], 0
            for step in steps:
                at += step
                numbers = numbers * ALPHABET + codes[:, at : at + places]
            yield np.where(codes[:, at:] == PAD, 0, numbers), DECAY ** at


def norms(lengths: np.ndarray) -> np.ndarray:
    total = np.zeros(len(lengths))
    for steps in STEPS:
        total += np.maximum(lengths + 2 - sum(steps), 0) * DECAY ** (2 * sum(steps))
    return np.sqrt(np.maximum(total, 1e-12))


def table_scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each string's scaled features."""
    codes, lengths = encoded(words)
    total = np.zeros(len(words))
    for numbers, weight in occurrences(codes):
        total += weights[numbers].sum(axis=1) * weight
    return total / norms(lengths)


def landmark_features(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The place of each subsequence of a landmark, and features (subsequences x landmarks)."""
    codes, lengths = encoded(landmarks)
    found = [(numbers, weight) for numbers, weight in occurrences(codes)]
    known = np.unique(np.concatenate([numbers.ravel() for numbers, _ in found]))
    place = np.zeros(ALPHABET**TAKEN, np.int32)
    known = known[known > 0]
    place[known] = np.arange(1, len(known) + 1)
    features = np.zeros((len(known) + 1, len(landmarks)))
    rows = np.arange(len(landmarks))
    for numbers, weight in found:
        for column in range(numbers.shape[1]):
            np.add.at(features, (place[numbers[:, column]], rows), weight)
    features[0] = 0
    return place, (features / norms(lengths)).astype(np.float32)


def kernel(words: list[str], place: np.ndarray, features: np.ndarray) -> np.ndarray:
    codes, lengths = encoded(words)
    total = np.zeros((len(words), features.shape[1]), np.float32)
    for numbers, weight in occurrences(codes):
        for column in range(numbers.shape[1]):
            total += features[place[numbers[:, column]]] * np.float32(weight)
    return total / norms(lengths)[:, None].astype(np.float32)


def squared_hinge(
    x: np.ndarray, positive: np.ndarray, negative: np.ndarray, ridge: float, rounds: int = 30
) -> np.ndarray:
    """Newton steps for a linear machine. A row counts as a positive and as a negative example with these weights; the last
    column of ``x`` is the constant and is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6

    def slacks(v):
        scores = (x @ v.astype(x.dtype)).astype(float)
        return np.maximum(0, 1 - scores), np.maximum(0, 1 + scores)

    def loss(v):
        up, down = slacks(v)
        return 0.5 * (penalty * v * v).sum() + 0.5 * (positive * up**2 + negative * down**2).sum()

    now = loss(w)
    for _ in range(rounds):
        up, down = slacks(w)
        curve = (positive * (up > 0) + negative * (down > 0)).astype(x.dtype)
        gradient = penalty * w - x.T @ (positive * up - negative * down).astype(x.dtype)
        hessian = np.diag(penalty)
        for start in range(0, len(x), 4096):
            part = x[start : start + 4096]
            hessian += (part * curve[start : start + 4096, None]).T @ part
        step = np.linalg.solve(hessian, gradient)
        scale = 1.0
        while scale > 1e-4 and loss(w - scale * step) > now:
            scale /= 2
        w = w - scale * step
        before, now = now, loss(w)
        if before - now < 1e-7 * max(1.0, before):
            break
    return w


def trained(
    words: list[str], toxic: np.ndarray, clean: np.ndarray, landmarks: list[str], ridge: float
) -> tuple[np.ndarray, np.ndarray, float]:
    """Subsequence numbers, their weights, and the bias of a machine over the landmarks' Nyström features.

    ``toxic`` and ``clean`` are the weights with which a word counts as an example of either class.
    """
    place, features = landmark_features(landmarks)
    values, vectors = np.linalg.eigh(kernel(landmarks, place, features).astype(float))
    strong = values > values.max() * 1e-6
    root = vectors[:, strong] / np.sqrt(values[strong])
    order = np.argsort([len(w) for w in words], kind="stable")
    x = np.empty((len(words), root.shape[1] + 1), np.float32)
    for start in range(0, len(order), 2048):
        part = order[start : start + 2048]
        x[part, :-1] = kernel([words[i] for i in part], place, features) @ root
    x[:, -1] = 1
    w = squared_hinge(x, toxic, clean, ridge)
    weights = features @ (root @ w[:-1])
    numbers = np.flatnonzero(place)
    return numbers, weights[place[numbers]], float(w[-1])
