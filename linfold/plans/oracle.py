"""Independent DuckDB SQL for every registered query (the correctness oracle).

Built as text from small templates; the tables ``lineitem`` and
``embeddings`` are the pre-registered views. Descents run as recursive
CTEs over the one-row training moments (list arithmetic), with the
early-stop test in the recursive ``WHERE``.
"""

from __future__ import annotations

from collections.abc import Sequence

from linfold.sources.fixtures import EMBED_FULL_WIDTH, EMBED_LABEL_BASE, EMBED_WIDTH, SIGNAL_LABEL_EXPR

TOL = 0.001
WIDTH = {"signal": 3, "embed": EMBED_WIDTH, "embed64": EMBED_FULL_WIDTH}


def r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


def _dbl(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def raw_cte(fixture: str) -> str:
    """``raw(point_id, label, f0..)`` for a fixture (labels not shifted)."""
    if fixture == "signal":
        return (
            "raw AS (SELECT CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)"
            f" AS point_id, CAST({SIGNAL_LABEL_EXPR} AS DOUBLE) AS label,"
            " l_quantity/50 AS f0, l_discount*10 AS f1, l_tax*10 AS f2 FROM lineitem)"
        )
    if fixture in ("embed", "embed64"):
        d = WIDTH[fixture]
        es = ", ".join(f"CAST(embedding[{k + 1}] AS DOUBLE) AS e{k}" for k in range(d))
        lo = ", ".join(f"min(e{k}) AS lo{k}" for k in range(d))
        hi = ", ".join(f"max(e{k}) AS hi{k}" for k in range(d))
        fs = ", ".join(f"CASE WHEN hi{k} = lo{k} THEN 0.0 ELSE (e{k} - lo{k}) / (hi{k} - lo{k}) END"
                       f" AS f{k}" for k in range(d))
        return (
            f"emb AS (SELECT vec_id AS point_id, CAST({EMBED_LABEL_BASE} + label AS DOUBLE)"
            f" AS label, {es} FROM embeddings),\n"
            f"rng AS (SELECT {lo}, {hi} FROM emb),\n"
            f"raw AS (SELECT point_id, label, {fs} FROM emb CROSS JOIN rng)"
        )
    raise ValueError(fixture)


def pts_cte(fixture: str) -> str:
    """``pts(point_id, label_raw, label, f0.., split)``: shifted, hash split."""
    d = WIDTH[fixture]
    fs = ", ".join(f"r.f{k}" for k in range(d))
    return (
        raw_cte(fixture) + ",\n"
        "pts AS (SELECT r.point_id, r.label AS label_raw,"
        " r.label - (SELECT min(label) FROM raw) AS label, " + fs + ","
        " CASE WHEN r._b < 800 THEN 'train' WHEN r._b < 900 THEN 'validation' ELSE 'test' END"
        " AS split FROM (SELECT *, CAST('0x' || substr(md5('42|' || CAST(point_id AS VARCHAR)),"
        " 1, 8) AS BIGINT) % 1000 AS _b FROM raw) r)"
    )


def z_names(d: int, interactions: bool) -> list[str]:
    width = d + d * d if interactions else d
    return [f"z{k}" for k in range(width)]


def zp_cte(d: int, interactions: bool, src: str = "pts", name: str = "zp") -> str:
    """``zp``: the model features z0.. (base features, then row-major products)."""
    zs = [f"f{k} AS z{k}" for k in range(d)]
    if interactions:
        zs += [f"f{i}*f{j} AS z{d + i * d + j}" for i in range(d) for j in range(d)]
    return f"{name} AS (SELECT *, {', '.join(zs)} FROM {src})"


def mom_cte(zs: Sequence[str], intercept: bool, where: str = "split = 'train'",
            src: str = "zp", name: str = "mom") -> str:
    """One-row moments with list-valued G (D x D) and b (D), optionally with a
    constant-1 feature appended last."""
    rows = []
    for a in zs:
        row = [f"sum({a}*{b})" for b in zs]
        if intercept:
            row.append(f"sum({a})")
        rows.append("[" + ", ".join(row) + "]")
    b = [f"sum({a}*label)" for a in zs]
    if intercept:
        rows.append("[" + ", ".join([f"sum({a})" for a in zs] + ["CAST(count(*) AS DOUBLE)"]) + "]")
        b.append("sum(label)")
    return (f"{name} AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(label*label) AS syy,"
            f" [{', '.join(rows)}] AS g, [{', '.join(b)}] AS b FROM {src} WHERE {where})")


def mom_cte_symmetric(zs: Sequence[str], where: str = "split = 'train'",
                      src: str = "zp", name: str = "mom") -> str:
    """``mom_cte`` with an intercept, each pair of terms summed once (wide models)."""
    cols = [*zs, "_one"]
    sums = [f"sum({a} * {b}) AS g{i}_{j}" for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
    sums += [f"sum({a} * label) AS b{i}" for i, a in enumerate(cols)]
    size = len(cols)
    g = ", ".join("[" + ", ".join(f"g{min(i, j)}_{max(i, j)}" for j in range(size)) + "]" for i in range(size))
    b = ", ".join(f"b{i}" for i in range(size))
    return (f"{name}_s AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(label * label) AS syy, {', '.join(sums)}"
            f" FROM (SELECT *, CAST(1.0 AS DOUBLE) AS _one FROM {src}) WHERE {where}),\n"
            f"{name} AS MATERIALIZED (SELECT n, syy, [{g}] AS g, [{b}] AS b FROM {name}_s)")


def moments_sql(fixture: str, interactions: bool = False) -> str:
    """Plain sums of every moment per split, over n."""
    d = WIDTH[fixture]
    zs = z_names(d, interactions)
    w = len(zs)
    names = ["n", "y", "yy"] + [f"x{k}" for k in range(w)] + [f"xy{k}" for k in range(w)] + \
        [f"xx{i}_{j}" for i in range(w) for j in range(i, w)]
    vals = ["count(*)", "sum(label)", "sum(label * label)"] + [f"sum({z})" for z in zs] + \
        [f"sum({z} * label)" for z in zs] + [f"sum({zs[i]} * {zs[j]})" for i in range(w) for j in range(i, w)]
    sel = ", ".join(f"CAST({v} AS DOUBLE) AS m{i}" for i, v in enumerate(vals))
    arr = ", ".join(["m0"] + [f"m{i} / m0" for i in range(1, len(vals))])
    nm = ", ".join(f"'{n}'" for n in names)
    return with_(pts_cte(fixture), zp_cte(d, interactions), f"mm AS (SELECT split, {sel} FROM zp GROUP BY split)") + (
        f"SELECT split, unnest([{nm}]) AS term, {r6(f'unnest([{arr}])')} AS value FROM mm")


def _zero_list(n: int, last: float | None = None) -> str:
    vals = ["CAST(0.0 AS DOUBLE)"] * n
    if last is not None:
        vals[-1] = _dbl(last)
    return "[" + ", ".join(vals) + "]"


def sgd_ctes(width: int, trials: Sequence[tuple[int, float, float, int]] | str,
             intercept: bool = True, mom: str = "mom", name: str = "sgd", tol: float = TOL) -> str:
    """``<name>_p(trial, reg, step, iters)``, the recursive ``<name>(trial, i, w, stop)``
    and ``<name>_fin(trial, w, iters_run)``. ``trials`` is a list of
    (trial, reg, step, iters) or a SELECT producing those columns."""
    size = width + 1 if intercept else width
    if isinstance(trials, str):
        params = f"{name}_p AS ({trials})"
    else:
        vals = ", ".join(f"({t}, {_dbl(reg)}, {_dbl(step)}, {int(it)})" for t, reg, step, it in trials)
        params = f"{name}_p(trial, reg, step, iters) AS (VALUES {vals})"
    w0 = _zero_list(size, 1.0 if intercept else None)
    sq = "lambda q: (q[1] - q[2]) * (q[1] - q[2])"
    return (
        f"{params},\n"
        f"{name}(trial, i, w, stop) AS (\n"
        f"  SELECT trial, 0, {w0}, false FROM {name}_p\n"
        "  UNION ALL\n"
        f"  SELECT trial, i, w, i > 1 AND sqrt(list_sum(list_transform(list_zip(w, w_old), {sq})))"
        f" < {tol!r} * greatest(sqrt(list_sum(list_transform(w, lambda v: v * v))), 1.0)\n"
        f"  FROM (SELECT s.trial, s.i + 1 AS i, s.w AS w_old,"
        f" list_transform(list_zip(s.w, m.g, m.b), lambda q: q[1] * (1.0 - p.step / sqrt(s.i + 1)"
        f" * p.reg) - p.step / sqrt(s.i + 1) * (list_dot_product(q[2], s.w) - q[3]) / m.n) AS w"
        f" FROM {name} s JOIN {name}_p p ON s.trial = p.trial CROSS JOIN {mom} m"
        f" WHERE NOT s.stop AND s.i < p.iters)),\n"
        f"{name}_fin AS (SELECT trial, arg_max(w, i) AS w, max(i) AS iters_run FROM {name}"
        " GROUP BY trial)"
    )


def gd_ctes(width: int, num_iters: int, alpha: float = 1.0, eta: float = 0.0,
            mom: str = "mom", name: str = "gd") -> str:
    """Recursive ``<name>(i, w, rmse)``: rmse is the training RMSE of w before
    update i; row ``num_iters`` holds the final weights."""
    w0 = _zero_list(width)
    rm = ("sqrt(greatest(list_dot_product(w, list_transform(m.g, lambda row:"
          " list_dot_product(row, w))) - 2 * list_dot_product(w, m.b) + m.syy, 0) / m.n)")
    return (
        f"{name}_w(i, w) AS (SELECT 0, {w0}\n"
        "  UNION ALL\n"
        f"  SELECT s.i + 1, list_transform(list_zip(s.w, m.g, m.b), lambda q: q[1] -"
        f" {_dbl(alpha)} / (m.n * sqrt(s.i + 1)) * (list_dot_product(q[2], s.w) - q[3]"
        f" + {_dbl(eta)} * q[1])) FROM {name}_w s CROSS JOIN {mom} m WHERE s.i < {int(num_iters)}),\n"
        f"{name} AS (SELECT i, w, {rm} AS rmse FROM {name}_w CROSS JOIN {mom} m)"
    )


def interact_by_kernel_sql(d: int, reg: float, step: float, iterations: int, fixture: str = "embed64") -> str:
    """The trainer on [x, all x_i x_j] with an intercept, without a term for any of
    them: the weights are sums a_r z_r over the training rows plus the intercept's,
    and z_r . z_s = x_r . x_s + (x_r . x_s)^2, so the a_r are what is descended."""
    x = "[" + ", ".join(f"f{k}" for k in range(d)) + "]"
    kernel = "list_dot_product(p.x, t.x) + pow(list_dot_product(p.x, t.x), 2)"
    return with_(
        pts_cte(fixture),
        f"x AS MATERIALIZED (SELECT point_id, split, label, {x} AS x FROM pts)",
        "t AS MATERIALIZED (SELECT * FROM x WHERE split = 'train')",
        f"k AS MATERIALIZED (SELECT p.point_id, p.split, p.label, list({kernel} ORDER BY t.point_id) AS k FROM x p CROSS JOIN t"
        " GROUP BY p.point_id, p.split, p.label)",
        "tr AS MATERIALIZED (SELECT list(k ORDER BY point_id) AS ks, list(label ORDER BY point_id) AS y, count(*) AS n FROM k WHERE split = 'train')",
        "r(i, a, b) AS (SELECT 0, list_transform(y, lambda v: CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE) FROM tr UNION ALL"
        " SELECT i + 1, list_transform(list_zip(a, e), lambda q: q[1] * (1.0 - s * " + _dbl(reg) + ") - s * q[2] / n),"
        " b * (1.0 - s * " + _dbl(reg) + ") - s * list_sum(e) / n FROM (SELECT i, a, b, n, " + _dbl(step) + " / sqrt(i + 1) AS s,"
        " list_transform(list_zip(ks, y), lambda q: list_dot_product(q[1], a) + b - q[2]) AS e FROM r CROSS JOIN tr"
        f" WHERE i < {iterations}))") + (
        f"SELECT split, CAST({iterations} AS BIGINT) AS iterations_run, CAST({d + d * d} AS BIGINT) AS width,"
        f" {r6('sqrt(avg(pow(list_dot_product(k, a) + b - label, 2)))')} AS rmse FROM k CROSS JOIN (SELECT a, b FROM r WHERE i = {iterations})"
        " GROUP BY split")


def predict_expr(w: str, zs: Sequence[str], intercept: bool) -> str:
    width = len(zs)
    core = f"list_dot_product({w}[1:{width}], [{', '.join(zs)}])"
    return f"({core} + {w}[{width + 1}])" if intercept else core


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
