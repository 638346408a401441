"""Budgets that documents can meet, and notices at the least coverage."""

import re

import numpy as np
import pytest
from test_operators import plain_alignment

from kinetra.llm import licenses, mixing


def reachable(lengths, counts, budget):
    """The largest sum up to budget, by sets of sums."""
    sums = np.zeros(budget + 1, dtype=bool)
    sums[0] = True
    for n, c in zip(lengths.tolist(), counts.tolist(), strict=True):
        for _ in range(c if 0 < n <= budget else 0):
            made = sums.copy()
            made[n:] |= sums[: budget + 1 - n]
            if (made == sums).all():
                break
            sums = made
    return int(np.flatnonzero(sums)[-1])


def test_budgets_are_met_where_documents_can_meet_them():
    lengths, counts = np.array([300, 350, 420, 500, 640]), np.full(5, 10)
    for budget in (10_001, 12_345, 15_099):
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all() and int((take * lengths).sum()) == reachable(lengths, counts, budget)
    rng = np.random.default_rng(1)
    far = 0
    for _ in range(150):
        lengths = np.unique(rng.integers(0, 900, int(rng.integers(1, 30))))
        counts = rng.integers(1, 12, lengths.size)
        budget = int(rng.integers(0, int((lengths * counts).sum()) + 2))
        take = mixing.fit_budget(lengths, counts, budget)
        made = int((take * lengths).sum())
        assert (take >= 0).all() and (take <= counts).all() and made <= budget
        far += reachable(lengths, counts, budget) - made > 1
        assert (take == mixing.fit_budget(lengths, counts, budget)).all()
    assert far <= 3


@pytest.mark.parametrize("how", ["left out", "replaced", "put in"])
def test_notices_at_the_least_coverage_are_found(how):
    rng = np.random.default_rng(2)
    index = licenses.Index(licenses.TEMPLATES, 4, 4, 0.8)
    missed = []
    for name, text in licenses.TEMPLATES.items():
        words = re.findall("[a-z0-9]+", text.lower())
        need = next(m for m in range(len(words) + 1) if m / len(words) >= 0.8)
        for _ in range(40):
            at = rng.choice(len(words), len(words) - need, replace=False)
            changed = [w if i not in at else {"left out": "", "replaced": f"q{i}", "put in": f"{w} q{i}"}[how] for i, w in enumerate(words)]
            around = [f"x{i}" for i in rng.integers(0, 99, 30)]
            data = " ".join(w for w in [*around, *changed, *around] if w)
            best = plain_alignment(words, data.split()) / len(words)
            if best >= 0.8 and not licenses.find_licenses(data.encode(), index, 6, 0.8):
                missed.append((name, data))
    assert not missed, len(missed)
