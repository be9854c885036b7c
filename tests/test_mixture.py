"""Gaussian mixture E/M steps and EM loop against NumPy brute force."""

import math

import numpy as np
import pytest

from fareseg.operators import mixture as X

COLS = ["a", "b", "c"]


def data(n=900, seed=0):
    rng = np.random.RandomState(seed)
    means = np.array([[0, 0, 0], [4, 1, -2], [-3, 5, 1]], float)
    x = np.concatenate([m + rng.normal(size=(n // 3, 3)) @ np.diag([1, 0.5, 2]) for m in means])
    return x


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                                 "trip_id long, a double, b double, c double")


def logpdf(x, mu, sig):
    d = len(mu)
    inv = np.linalg.inv(sig)
    _, logdet = np.linalg.slogdet(sig)
    dev = x - mu
    return -0.5 * (d * math.log(2 * math.pi) + logdet + np.einsum("na,ab,nb->n", dev, inv, dev))


def resp(x, m):
    lw = np.stack([logpdf(x, m.mu[j], m.sigma[j]) + math.log(m.phi[j]) for j in range(m.k)], 1)
    e = np.exp(lw - lw.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def start(x):
    lab = np.repeat([0, 1, 2], len(x) // 3)
    mu = np.array([x[lab == j].mean(0) for j in range(3)])
    sig = np.array([np.cov(x[lab == j].T, bias=True) for j in range(3)])
    return X.Mixture(np.full(3, 1 / 3), mu, sig)


def brute_em(x, m, rounds):
    """Reference round: phi first, then mu/sigma with new phi and old Gaussians."""
    for _ in range(rounds):
        phi = resp(x, m).mean(0)
        m = X.Mixture(phi, m.mu, m.sigma)
        r = resp(x, m)
        w = r.sum(0)
        mu = (r.T @ x) / w[:, None]
        sig = np.array([((x - mu[j]).T * r[:, j]) @ (x - mu[j]) / w[j] for j in range(3)])
        m = X.Mixture(phi, mu, sig)
    return m


def test_responsibilities_match_numpy(spark):
    x = data()
    m = start(x)
    rows = X.responsibilities(frame(spark, x), COLS, m).collect()
    got = np.array([[r[f"_r{j}"] for j in range(3)] for r in sorted(rows, key=lambda r: r.trip_id)])
    assert np.allclose(got, resp(x, m), atol=1e-12)
    assert np.allclose(got.sum(1), 1.0)
    dens = X.log_density(frame(spark, x), COLS, m).collect()
    d = np.array([[r[f"_ld{j}"] for j in range(3)] for r in sorted(dens, key=lambda r: r.trip_id)])
    assert np.allclose(d[:, 1], logpdf(x, m.mu[1], m.sigma[1]), atol=1e-9)


def test_em_matches_brute_force(spark):
    x = data()
    m0 = start(x)
    got, lagged = X.gmm_fit(frame(spark, x), COLS, m0, tol=0.0, max_iter=3)
    want = brute_em(x, m0, 3)
    assert got.rounds == 3
    assert np.allclose(got.phi, want.phi, atol=1e-10)
    assert np.allclose(got.mu, want.mu, atol=1e-8)
    assert np.allclose(got.sigma, want.sigma, atol=1e-8)
    assert np.allclose(lagged.phi, got.phi)


def test_em_converges_and_phi_sums_to_one(spark):
    x = data(seed=2)
    m, _ = X.gmm_fit(frame(spark, x), COLS, start(x), em_schedule="single", max_iter=300)
    assert m.converged and abs(m.phi.sum() - 1) < 1e-12
    for s in m.sigma:
        assert np.allclose(s, s.T) and np.linalg.eigvalsh(s).min() > 0


def test_singular_sigma_uses_pseudo_inverse(spark):
    x = data()
    x[:, 2] = 1.0  # constant feature: every covariance is singular
    m = start(x)
    g = X.prepare(m.mu[0], m.sigma[0])
    assert g.rank == 2
    rows = X.responsibilities(frame(spark, x), COLS, m).collect()
    assert all(math.isfinite(r["_r0"]) for r in rows)
    fit, _ = X.gmm_fit(frame(spark, x), COLS, m, max_iter=5)
    assert np.all(np.isfinite(fit.mu))


def test_sigma_as_written_matches_row_formula(spark):
    x = data(300)
    m = start(x)
    r = resp(x, m)
    center = x.mean(0)
    df = frame(spark, x)
    rs = X.responsibilities(df, COLS, m)
    W, S, Q = X.weighted_moments(rs, COLS, [f"_r{j}" for j in range(3)], center)
    got = X.sigma_as_written(W, S, Q, center)
    mu = (r.T @ x) / r.sum(0)[:, None]
    for j in range(3):
        # the reference's covMat: scalar feature j of each row minus mu_j
        dev = x[:, j][:, None] - mu[j][None, :]
        want = (dev.T * r[:, j]) @ dev / r[:, j].sum()
        assert np.allclose(got[j], want, atol=1e-9)


def test_uniform_underflow_falls_back_to_phi(spark):
    x = np.array([[1e4, 1e4, 1e4], [0.0, 0.0, 0.0]])
    m = X.Mixture(np.array([0.7, 0.3]), np.zeros((2, 3)), np.array([np.eye(3), np.eye(3) * 2]))
    rows = sorted(X.responsibilities(frame(spark, x), COLS, m, underflow="uniform").collect(), key=lambda r: r.trip_id)
    assert rows[0]["_r0"] == pytest.approx(0.7) and rows[0]["_r1"] == pytest.approx(0.3)
    exact = sorted(X.responsibilities(frame(spark, x), COLS, m).collect(), key=lambda r: r.trip_id)
    assert exact[0]["_r1"] == pytest.approx(1.0)


def test_lagged_model_is_last_phi_with_previous_gaussians(spark):
    x = data(seed=5)
    df = frame(spark, x)
    one, _ = X.gmm_fit(df, COLS, start(x), tol=0.0, max_iter=1)
    two, lagged = X.gmm_fit(df, COLS, start(x), tol=0.0, max_iter=2)
    assert np.allclose(lagged.phi, two.phi)
    assert np.allclose(lagged.mu, one.mu) and np.allclose(lagged.sigma, one.sigma)


def test_em_with_as_written_covariance_and_ridge(spark):
    x = data(seed=5)
    m0 = start(x)
    for covariance, ridge in (("as_written", 0.1), ("weighted", 0.1)):
        got, _ = X.gmm_fit(frame(spark, x), COLS, m0, tol=0.0, max_iter=2, covariance=covariance, ridge=ridge)
        m = X.Mixture(m0.phi, m0.mu, m0.sigma + ridge * np.eye(3))
        for _ in range(2):
            phi = resp(x, m).mean(0)
            r = resp(x, X.Mixture(phi, m.mu, m.sigma))
            w = r.sum(0)
            mu = (r.T @ x) / w[:, None]
            dev = [x[:, [j]] - mu[j] if covariance == "as_written" else x - mu[j] for j in range(3)]
            sig = np.array([(dev[j].T * r[:, j]) @ dev[j] / w[j] for j in range(3)])
            m = X.Mixture(phi, mu, sig + ridge * np.eye(3))
        assert np.allclose(got.phi, m.phi, atol=1e-9) and np.allclose(got.sigma, m.sigma, atol=1e-8)
    with pytest.raises(ValueError):
        X.gmm_fit(frame(spark, x), COLS, m0, covariance="other")


def test_a_rows_responsibilities_depend_on_nothing_but_the_row():
    x = np.random.default_rng(0).permutation(data(6000))
    m, center = start(data()), np.array([0.5, -1.0, 0.25])

    def resps(rows, model=m, underflow="exact"):
        return np.concatenate([r.T.copy() for r, _ in X._EStep(model, center, underflow).chunks(np.asfortranarray(rows))])

    whole = resps(x)
    assert np.allclose(whole, resp(x, m), atol=1e-12)
    for at in (1, 7, 500, 2047, 2048, 5999):
        assert (resps(x[at:]) == whole[at:]).all() and (resps(x[:at]) == whole[:at]).all()
    flat = x.copy()
    flat[:, 2] = 1.0  # a constant feature: rows off it lie off every support
    single = X.Mixture(m.phi, *map(np.array, zip(*[(flat[i::3].mean(0), np.cov(flat[i::3].T, bias=True)) for i in range(3)])))
    odd = np.vstack([flat[:5], flat[:5] + [0.0, 0.0, 9.0]])
    r = resps(odd, single)
    assert np.allclose(r.sum(axis=1), 1.0) and (r[5:] == m.phi).all() and not (r[:5] == m.phi).all()
    assert (resps(x[:3] + 1e4, m, "uniform") == m.phi).all()


def test_a_scan_projects_all_components_at_once():
    x, m = np.asfortranarray(data(3000)), start(data())
    products = []

    class Axes(np.ndarray):
        def __matmul__(self, other):
            products.append(other.shape[1])
            return np.asarray(self) @ other

    step = X._EStep(m, np.zeros(3), "exact")
    step.axes = step.axes.view(Axes)
    assert sum(r.shape[1] for r, _ in step.chunks(x)) == len(x)
    assert products == [X.CHUNK] * math.ceil(len(x) / X.CHUNK)


def test_moments_far_from_the_origin_keep_their_bits():
    """Pieces are cut below the centred features' reach, not below that of the features."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2)) * 1e-4
    r = rng.random((4000, 2))
    W, S, Q = X._moments(X.Folds.joined(X._moment_pieces(r, x, np.abs(x).max(axis=0))), 2, 2)
    for j in range(2):
        for a in range(2):
            assert S[j, a] == pytest.approx(math.fsum(r[:, j] * x[:, a]), rel=1e-13, abs=1e-18)
            for b in range(2):
                assert Q[j, a, b] == pytest.approx(math.fsum(r[:, j] * x[:, a] * x[:, b]), rel=1e-13, abs=1e-20)


def test_reach_is_that_of_centred_rows(spark):
    from fareseg.operators.kmeans import loop_input

    x, center = data(300) - 74.0, np.full(3, -74.0)
    df = frame(spark, x)
    want = np.abs(x - center).max(axis=0)
    assert (X.centred_reach(df, COLS, center) == want).all()
    blocks, _ = loop_input(df, COLS)
    assert (X.centred_reach(blocks, COLS, center) == want).all()
    blocks.unpersist()
    empty, _ = loop_input(df.limit(0), COLS)
    assert not X.centred_reach(empty, COLS, center).any()
