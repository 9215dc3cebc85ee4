"""SQL of linear models: the normal equations of a table, solved by elimination, one step a table expression."""

from __future__ import annotations

from collections.abc import Sequence


def solved(name: str, source: str, features: Sequence[str], label: str, ridge: float = 0.0, keys: str = "") -> str:
    """Table expressions ending in `name`, with weights `w0, w1, …` and intercept `c` of `source`.

    `ridge` is the penalty of the library's linear models. `keys` are columns to fit a model for each value of.
    """
    p = len(features)
    group = f"{keys}, " if keys else ""
    by = f" GROUP BY {keys}" if keys else ""
    cells = [f"covar_pop({features[i]}, {features[j]}) AS a{i}_{j}" for i in range(p) for j in range(p) if i != j]
    penalty = f" * (1 + {ridge} / stddev_pop({label}))" if ridge else ""
    cells += [f"var_pop({f}){penalty} AS a{i}_{i}" for i, f in enumerate(features)]
    cells += [f"covar_pop({f}, {label}) AS b{i}" for i, f in enumerate(features)]
    cells += [f"avg({f}) AS m{i}" for i, f in enumerate(features)] + [f"avg({label}) AS m"]
    steps = [f"{name}_0 AS (SELECT {group}{', '.join(cells)} FROM {source}{by})"]
    for k in range(p - 1):
        changed = [f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j} AS a{i}_{j}" for i in range(k + 1, p) for j in range(k + 1, p)]
        changed += [f"b{i} - a{i}_{k} / a{k}_{k} * b{k} AS b{i}" for i in range(k + 1, p)]
        steps.append(f"{name}_{k + 1} AS (SELECT * REPLACE ({', '.join(changed)}) FROM {name}_{k})")
    before = f"{name}_{p - 1}"
    for k in range(p - 1, -1, -1):
        rest = "".join(f" - a{k}_{j} * w{j}" for j in range(k + 1, p))
        steps.append(f"{name}_w{k} AS (SELECT *, (b{k}{rest}) / a{k}_{k} AS w{k} FROM {before})")
        before = f"{name}_w{k}"
    weights = ", ".join(f"w{k}" for k in range(p))
    centre = "".join(f" - w{k} * m{k}" for k in range(p))
    return ",\n".join([*steps, f"{name} AS (SELECT {group}{weights}, m{centre} AS c FROM {before})"])


def predicted(features: Sequence[str]) -> str:
    """The prediction of a row next to the weights of `solved`."""
    return "c" + "".join(f" + w{k} * {f}" for k, f in enumerate(features))


def metrics(label: str, prediction: str, source: str) -> str:
    """One row of regression measures to eight significant digits, columns as `regression_metrics`."""
    e = f"({label} - {prediction})"
    logs = f"(ln(1 + {prediction}) - ln(1 + {label}))"
    short = "CAST(printf('%.7e', CAST({} AS DOUBLE)) AS DOUBLE)".format
    valid = f"min({prediction}) > -1 AND min({label}) > -1"
    logged = f"CASE WHEN {prediction} > -1 AND {label} > -1 THEN {logs} * {logs} END"
    return f"""SELECT {short('mse')} AS mse, {short('sqrt(mse)')} AS rmse, {short('mae')} AS mae, {short('1 - mse / v')} AS r2,
      CASE WHEN ok THEN {short('sqrt(l)')} END AS rmsle, {short('ln(sqrt(mse))')} AS log_rmse
      FROM (SELECT avg({e} * {e}) AS mse, avg(abs{e}) AS mae, var_pop({label}) AS v, avg({logged}) AS l, {valid} AS ok FROM {source})"""
