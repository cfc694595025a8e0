"""Pairwise quality ranking against plain Python: utility, pair loss, quantile threshold."""

import math

import numpy as np

from inkmill.llm import quality_ranking as qr


def plain_utility(model, row):
    total = 0.0
    for j, value in enumerate(row):
        total += model.weights[j, sum(value > e for e in model.edges[j])]
    return total


def pair_loss(utility, good, bad):
    return sum(math.log1p(math.exp(utility[b] - utility[g])) for g in good for b in bad) / (len(good) * len(bad))


def fitted(n=120, shift=1.0, share_bad=0.3):
    rng = np.random.default_rng(6)
    good, bad = rng.standard_normal((n, 3)) + [shift, 0, 0], rng.standard_normal((n, 3))
    good, bad = np.round(good, 1), np.round(bad, 1)  # ties in features and at bin edges
    return good, bad, qr.rank_fit(good, bad, share_bad, pairs=40_000)


def test_utility_loss_threshold_and_score():
    good, bad, model = fitted()
    both = np.concatenate([good, bad])
    utility = model.utility(both)
    assert np.allclose(utility, [plain_utility(model, row) for row in both], atol=1e-12)
    # The first feature alone tells the classes apart; its ranking is a bar the fit must clear.
    at = range(len(good)), range(len(good), len(both))
    assert pair_loss(utility, *at) < pair_loss(both[:, 0], *at) + 0.02 < math.log(2)
    # The rows weigh as the labels do: below the cut lies the share of bad labels.
    weight = np.where(np.arange(len(both)) < len(good), 0.7 / len(good), 0.3 / len(bad))
    below, upto = weight[utility < model.cut].sum(), weight[utility <= model.cut].sum()
    assert below - max(weight) <= 0.3 <= upto + max(weight)
    scores = model.score(both)
    plain = [1 / (1 + math.exp(-model.slope * (plain_utility(model, row) - model.cut))) for row in both]
    assert np.allclose(scores, plain, atol=1e-12)
    assert ((scores >= 0.5) == (utility >= model.cut)).all()


def test_equal_utilities_at_the_threshold():
    good, bad = np.ones((50, 2)), np.ones((50, 2))
    model = qr.rank_fit(good, bad, 0.5, pairs=1_000)
    assert np.allclose(model.score(np.ones((3, 2))), 0.5)


def test_one_class_scores_half():
    for good, bad in ((np.ones((4, 2)), np.zeros((0, 2))), (np.zeros((0, 2)), np.ones((4, 2)))):
        assert np.allclose(qr.rank_fit(good, bad, 0.5).score(np.arange(6.0).reshape(3, 2)), 0.5)
