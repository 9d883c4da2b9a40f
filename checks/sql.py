"""DuckDB text of the study tables, written apart from the Spark operators."""

from __future__ import annotations

from .inputs import EXPOSURES, SALT
from .views import VIEWS

# Fixed values, spelled apart from the library's own configuration: code patterns
# of each flag, and the variables with their public names.
_CODES = {
    "asthma_flag": "493|J45",
    "copd_flag": "491|492|496|J44",
    "respiratory_infection_flag": "46[0-6]|48[0-7]|J0[0-6]|J09|J1[0-8]|J2[0-2]",
    "cardiovascular_flag": "41[0-4]|I2[0-5]",
    "stroke_flag": "43[0-8]|I6[0-4]",
    "diabetes_flag": "250|E10|E11|E13",
    "pregnancy_flag": "6[3-7][0-9]|V22|V23|V24|V27|V28|O",
    "mental_health_flag": "29[0-9]|30[0-9]|31[0-9]|F",
}
_NAMES = {
    "prop_light_coverage": "hms_smoke_light", "prop_med_coverage": "hms_smoke_medium",
    "prop_heavy_coverage": "hms_smoke_heavy", "dusmass25": "pm25_dust",
    "bcsmass": "pm25_black_carbon", "tmax": "temp_maximum", "tmin": "temp_minimum",
}
FLAGS = list(_CODES)
_flags = ",\n  ".join(f"coalesce(regexp_matches(dx_primary, '^({codes})'), false) as {flag}"
                      for flag, codes in _CODES.items())
_any = ",\n  ".join(f"bool_or({f}) as {f}" for f in FLAGS)
_cells = ",\n  ".join(f"max(case when variable = '{v}' then value end) as {v}"
                      for v in _NAMES)
_renamed = ", ".join(f"{v} as {n}" for v, n in _NAMES.items())
_melted = "\nunion all ".join(
    f"select person_id, ym, '{n}' as exposure_id, 'mean' as metric, {v} as value "
    f"from person_exposures where {v} is not null"
    for v, n in _NAMES.items())

# name -> (tables it reads, text)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {name: ((), sql) for name, sql in VIEWS.items()}
TABLES["visit"] = (("v_visit",), f"""
select visit_id, sha256(concat(cast(person_key as varchar), '|{SALT}')) as person_id,
  make_date(src_year, src_month, 1) as admit_date, dx1 as dx_primary, zip5, age, female, race,
  db_type
from v_visit""")
TABLES["best_tract"] = (("v_crosswalk",), """
select zip as zip5, tract as tract_geoid from (
  select *, row_number() over (partition by zip order by res_ratio desc nulls last, tract) as rn
  from v_crosswalk) where rn = 1""")
TABLES["geocoded"] = (("visit", "best_tract"), """
select visit.*, tract_geoid from visit left join best_tract using (zip5)""")
TABLES["flagged"] = (("geocoded",), f"""
select *,
  {_flags}
from geocoded""")
TABLES["person_month"] = (("flagged",), f"""
select *, cast(year(ym) as int) as year, cast(month(ym) as int) as month,
  case when month(ym) in (12, 1, 2) then 'winter' when month(ym) <= 5 then 'spring'
    when month(ym) <= 8 then 'summer' else 'fall' end as season
from (
select person_id, admit_date as ym,
  arg_max(zip5, visit_id) filter (where zip5 is not null) as zip5,
  arg_max(tract_geoid, visit_id) filter (where tract_geoid is not null) as tract_geoid,
  count(*) as n_visits,
  string_agg(distinct db_type, ',' order by db_type) as db_type,
  arg_min(age, visit_id) filter (where age is not null) as age,
  arg_min(female, visit_id) filter (where female is not null) as female,
  arg_min(race, visit_id) filter (where race is not null) as race,
  {_any}
from flagged group by person_id, admit_date)""")
TABLES["exposure_subset"] = (("v_exposure", "person_month"), f"""
select * from v_exposure
where try_cast(year as int) between greatest(1990, (select min(year) from person_month))
    and least(2024, (select max(year) from person_month))
  and geoid in (select distinct zip5 from person_month where zip5 is not null)
  and variable in ({', '.join(f"'{v}'" for v in _NAMES)})""")
TABLES["exposure_wide"] = (("exposure_subset",), f"""
select geoid as zip5, year, month,
  {_cells}
from exposure_subset group by geoid, year, month""")
TABLES["person_exposures"] = (("person_month", "exposure_wide"), f"""
select p.* replace (cast(p.year as varchar) as year), {', '.join(_NAMES)}
from person_month p left join exposure_wide w
  on p.zip5 is not distinct from w.zip5 and cast(p.year as varchar) = w.year
    and p.month = w.month""")
TABLES["rollup"] = (("person_exposures",), _melted)
TABLES["scan_input"] = (("person_exposures",), f"""
select person_id, ym, cast(year as int) as year, month, season, db_type, age, female, race, tract_geoid,
  {', '.join(FLAGS)}, {_renamed}
from person_exposures""")


def with_tables(select: str, *names: str, extra: dict[str, str] | None = None,
                extra_materialized: bool = True) -> str:
    """``select`` preceded by the named tables and all they read."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dependency in TABLES[name][0]:
            visit(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} as materialized ({TABLES[name][1]})" for name in ordered]
    parts += [f"{name} as materialized ({text})" for name, text in (extra or {}).items()]
    return "with " + ",\n".join(parts) + "\n" + select


def newton(prefix: str, rows: str, columns: list[str], steps: int = 7) -> dict[str, str]:
    """Logistic fits in SQL, every step solved by elimination.

    ``rows`` has ``fit, n, k`` and the design ``columns``.  The first step uses
    fitted values of 3/4 and 1/4, later ones are Newton steps; a fit ends with
    the first step whose deviance differs by less than 1e-8 from the one
    before, keeping the variance that step was solved with.  ``<prefix>_fit``
    has estimate ``b`` and variance ``v`` of the first column, which is
    eliminated last: its variance is then the inverse of the last pivot.
    """
    x = ["1.0", *columns[1:], columns[0]]
    p = len(x)
    betas = [f"b{i}" for i in range(p)]
    tables: dict[str, str] = {}
    previous = f"{prefix}_b0"
    tables[previous] = (f"select fit, {', '.join(f'0.0 as {b}' for b in betas)}, 0.0 as v "
                        f"from {rows} group by fit")
    eta = " + ".join(f"b{i} * {x[i]}" for i in range(p))
    ends = []
    for step in range(1, steps + 2):
        if step == 1:
            score = ("select *, 0.1875 * (ln(3) + 4 / 3.0) * (2 * k - n) as r, 0.1875 * n as w, "
                     "-2 * n * ln(0.75) as d")
        else:
            score = ("select *, k - n * mu as r, n * mu * (1 - mu) as w, "
                     "-2 * (k * ln(mu) + (n - k) * ln(1 - mu)) as d")
        sums = f"{prefix}_s{step}"
        tables[sums] = (
            "select fit, sum(d) as dev, any_value(v) as v, "
            + ", ".join(f"any_value({b}) as {b}" for b in betas) + ", "
            + ", ".join(f"sum(w * {x[i]} * {x[j]}) as m_{i}_{j}"
                        for i in range(p) for j in range(i, p)) + ", "
            + ", ".join(f"sum(r * {x[i]}) as g_{i}" for i in range(p))
            + f" from ({score} from (select *, 1 / (1 + exp(-({eta}))) as mu "
              f"from {rows} join {previous} using (fit))) group by fit")
        if step > 1:
            ends.append(f"select a.fit, {step - 1} as step, a.b{p - 1} as b, a.v from {sums} a "
                        f"join {prefix}_s{step - 1} c using (fit) "
                        f"where abs(a.dev - c.dev) / (abs(a.dev) + 0.1) < 1e-8")
        if step > steps:
            break
        # Upper triangle only: level k holds the system without unknowns 0..k-1.
        level = sums
        for k in range(1, p):
            swept, j0 = f"{prefix}_m{step}_{k}", k - 1
            cells = [f"m_{i}_{j} - m_{j0}_{i} * m_{j0}_{j} / m_{j0}_{j0} as m_{i}_{j}"
                     for i in range(k, p) for j in range(i, p)]
            cells += [f"g_{i} - m_{j0}_{i} * g_{j0} / m_{j0}_{j0} as g_{i}" for i in range(k, p)]
            tables[swept] = f"select fit, {', '.join(cells)} from {level}"
            level = swept
        # Back substitution, the last unknown first.
        at = [sums, *[f"{prefix}_m{step}_{k}" for k in range(1, p)]]
        solved = f"{prefix}_x{step}_{p}"
        tables[solved] = f"select fit, 1 / m_{p - 1}_{p - 1} as v from {at[-1]}"
        for i in reversed(range(p)):
            known = "".join(f" - m_{i}_{j} * x{j}" for j in range(i + 1, p))
            xs = "".join(f"x{j}, " for j in range(i + 1, p))
            tables[f"{prefix}_x{step}_{i}"] = (
                f"select fit, {solved}.v, {xs}(g_{i}{known}) / m_{i}_{i} as x{i} "
                f"from {solved} join {at[i]} using (fit)")
            solved = f"{prefix}_x{step}_{i}"
        previous = f"{prefix}_b{step}"
        tables[previous] = (f"select fit, {solved}.v, "
                            + ", ".join(f"b{i} + x{i} as b{i}" for i in range(p))
                            + f" from {sums} join {solved} using (fit)")
    tables[f"{prefix}_fit"] = (
        f"select fit, b, v from ({' union all '.join(ends)}) "
        "qualify row_number() over (partition by fit order by step) = 1")
    return tables


def within(prefix: str, rows: str, steps: int = 25) -> dict[str, str]:
    """Logistic fits of ``x`` and ``c`` beside one factor ``level``, by demeaning inside its levels.

    Residuals from weighted level means regress on one another as the columns do
    beside all indicators, so two unknowns are left to solve for.  Steps and end
    are those of :func:`newton`; a fit that never ends keeps its last step.
    """
    tables: dict[str, str] = {}
    for step in range(1, steps + 1):
        if step == 1:
            tables[f"{prefix}_w1"] = (
                f"select fit, level, x, c, 0.0 as b, 0.0 as v, 0.1875 * n as w, "
                f"(ln(3) + 4 / 3.0) * (2 * k - n) / n as t, -2 * n * ln(0.75) as d from {rows} where n > 0")
        else:
            tables[f"{prefix}_w{step}"] = (
                "select fit, level, x, c, b, v, n * mu * (1 - mu) as w, eta + (k - n * mu) / (n * mu * (1 - mu)) as t, "
                "-2 * (k * ln(mu) + (n - k) * ln(1 - mu)) as d from (select *, 1 / (1 + exp(-eta)) as mu from ("
                f"select r.*, p.b, p.v, p.b * x + p.b2 * c + p.t0 - p.b * p.x0 - p.b2 * p.c0 as eta "
                f"from {rows} r join {prefix}_b{step - 1} p on r.fit = p.fit and r.level = p.level where n > 0))")
        tables[f"{prefix}_m{step}"] = (
            "select fit, level, any_value(b) as b, any_value(v) as v, sum(d) as d, sum(w * x) / sum(w) as x0, "
            "sum(w * c) / sum(w) as c0, sum(w * t) / sum(w) as t0 "
            f"from {prefix}_w{step} group by fit, level")
        tables[f"{prefix}_s{step}"] = (
            "select fit, sum(w * (x - x0) ** 2) as xx, sum(w * (x - x0) * (c - c0)) as xc, "
            "sum(w * (c - c0) ** 2) as cc, sum(w * (x - x0) * (t - t0)) as xt, sum(w * (c - c0) * (t - t0)) as ct "
            f"from {prefix}_w{step} join (select fit, level, x0, c0, t0 from {prefix}_m{step}) using (fit, level) "
            "group by fit")
        tables[f"{prefix}_d{step}"] = (f"select fit, {step} as step, sum(d) as dev, any_value(b) as b, "
                                       f"any_value(v) as v from {prefix}_m{step} group by fit")
        tables[f"{prefix}_b{step}"] = (
            "select fit, level, x0, c0, t0, (xt * cc - ct * xc) / (xx * cc - xc * xc) as b, "
            "(ct * xx - xt * xc) / (xx * cc - xc * xc) as b2, cc / (xx * cc - xc * xc) as v "
            f"from {prefix}_m{step} join {prefix}_s{step} using (fit)")
    every = " union all ".join(f"select * from {prefix}_d{step}" for step in range(1, steps + 1))
    tables[f"{prefix}_fit"] = (
        f"select fit, b, v from (select *, lag(dev) over (partition by fit order by step) as before from ({every})) "
        f"where step > 1 and (abs(dev - before) / (abs(dev) + 0.1) < 1e-8 or step = {steps}) "
        "qualify row_number() over (partition by fit order by step) = 1")
    return tables
