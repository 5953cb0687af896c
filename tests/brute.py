"""Plain-Python statements of the published definitions, for small inputs."""

from __future__ import annotations

from collections import Counter


def table(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = rows[i - 1][j - 1] + 1 if x == y else max(rows[i - 1][j], rows[i][j - 1])
    return rows


def places(a, b):
    t, i, j, out = table(a, b), len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            out.append(i - 1)
            i, j = i - 1, j - 1
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out


def words(text):
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def f1(hits, n, m):
    return 2 * hits / (n + m) if hits else 0.0


def rouge_l(prediction, reference):
    p, r = words(prediction), words(reference)
    return f1(table(r, p)[-1][-1], len(p), len(r))


def rouge_lsum(prediction, reference):
    p = [words(s) for s in prediction.split("\n") if s]
    r = [words(s) for s in reference.split("\n") if s]
    left_p, left_r = Counter(sum(p, [])), Counter(sum(r, []))
    hits = 0
    for sentence in r:
        covered = set()
        for candidate in p:
            covered.update(places(sentence, candidate))
        for i in sorted(covered):
            token = sentence[i]
            if left_p[token] and left_r[token]:
                hits += 1
                left_p[token] -= 1
                left_r[token] -= 1
    return f1(hits, sum(map(len, p)), sum(map(len, r)))


def moving_average(values, w):
    if w <= 1 or len(values) <= w:
        return list(values)
    return [None] * (w - 1) + [sum(values[i - w + 1 : i + 1]) / w for i in range(w - 1, len(values))]


def exponential(values, w):
    if w <= 1 or len(values) <= w:
        return list(values)
    a, out = 2 / (w + 1), [values[0]]
    for v in values[1:]:
        out.append(a * v + (1 - a) * out[-1])
    return out


def savgol(values, window):
    import numpy as np

    n = len(values)
    if window <= 1 or n <= window:
        return list(values)
    w = window if window % 2 else window - 1
    if w < 3:
        return list(values)
    h, out = w // 2, []
    for i in range(n):
        start = min(max(i - h, 0), n - w)
        fit = np.polyfit(np.arange(w), values[start : start + w], 2)
        out.append(float(np.polyval(fit, i - start)))
    return out
