from math import comb

from kinfold.llm import decontaminate as d


def missed(m, w, shared, radius=20):
    """The share of windows (w shingles, ``shared`` of them of the item's m) beyond the radius, if bits of hashes are even and independent."""
    share = lambda n: [comb(n, i) / 2**n for i in range(n + 1)]
    p = 0.0
    for i, a in enumerate(share(shared)):
        item = sum(b for j, b in enumerate(share(m - shared)) if 2 * (i + j) > m)
        window = sum(b for j, b in enumerate(share(w - shared)) if 2 * (i + j) > w)
        p += a * (item * (1 - window) + window * (1 - item))
    return sum(comb(64, n) * p**n * (1 - p) ** (64 - n) for n in range(radius + 1, 65))


def test_the_stated_rates():
    """In 10,000, at the similarity of 0.8: full windows, a worst end of a text, and the worst for items of 11 shingles or more."""
    every = {(m, w, s): 1e4 * missed(m, w, s) for m in range(1, 46) for w in range(1, m + 1) for s in range(1, w + 1) if 0.8 - 1e-9 <= s / (m + w - s)}
    told = {(18, 18, 16): "1.0", (45, 45, 40): "2.3", (15, 12, 12): "7.6", (5, 4, 4): "51.8"}
    assert max(every, key=every.get) == (5, 4, 4) and f"{max(v for x, v in every.items() if x[0] >= 11):.1f}" == told[15, 12, 12]
    for shape, text in told.items():
        assert f"{every[shape]:.1f}" == text and text in d.contaminated.__doc__
