"""The seawater formulas as nested SQL, with the same steps in the same order."""

from __future__ import annotations

from checks import seawater_tables as sw


def poly(coefficients: list, at: str) -> str:
    """Horner form, from the highest power down; zero coefficients add nothing."""
    text = _term(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {at})" if c == 0.0 else f"({text} * {at} + {_term(c)})"
    return text


def _term(c) -> str:
    return f"({c!r}::double)" if isinstance(c, float) else c


def steps(source: str, stages: list[dict[str, str]], drop: list[str], result: str, name: str) -> str:
    sql = source
    made: set[str] = set()
    for stage in stages:
        again = [n for n in stage if n in made]
        replaced = f" REPLACE ({', '.join(f'{stage[n]} AS {n}' for n in again)})" if again else ""
        added = "".join(f", {e} AS {n}" for n, e in stage.items() if n not in made)
        made |= set(stage)
        sql = f"(SELECT *{replaced}{added} FROM {sql})"
    return f"SELECT * EXCLUDE ({', '.join(sorted(made) + drop)}), cast({result} AS float) AS {name} FROM {sql}"


def abs_salinity_sql(source: str) -> str:
    return f"SELECT *, cast(cast(PSAL AS double) * ({sw.SSO / 35!r}::double) AS float) AS ABS_SAL_COMPUTED FROM {source}"


def ct_sql(source: str, sa: str, t: str, p: str) -> str:
    by_x: dict[int, dict[int, str]] = {}
    for (i, j), row in sw.ENTROPY_ROWS.items():
        by_x.setdefault(i, {})[j] = poly(list(row), "s_z")
    surface = sw.surface_entropy_rows()
    top = max(surface)
    warming = f"({poly([-8.38241357039698e-6, 1.77803965218656e-8], 's_t')} + s_u * 2.83933368585534e-8::double + s_p * 1.71155619208233e-10::double)"
    haline = poly([8.65483913395442e-6, -1.41636299744881e-6], "s_u")
    stages = [
        {"s_sa": f"cast({sa} AS double)", "s_t": f"cast({t} AS double)", "s_p": f"cast({p} AS double)"},
        {
            "s_x": f"sqrt(s_sa * {sw.SALINITY_SCALE!r}::double)",
            "s_y": "s_t * 0.025::double",
            "s_z": "s_p * 1e-4::double",
            "s_u": f"s_sa * ({35 / sw.SSO!r}::double)",
        },
        {
            "s_q": f"s_t + s_p * ({haline} - s_p * 7.38286467135737e-9::double + s_t * {warming})",
            **{f"s_e{i}": poly(sw.dense(row), "s_y") for i, row in by_x.items()},
        },
        {
            "s_y": "s_q * 0.025::double",
            "s_target": poly(sw.dense({i: f"s_e{i}" for i in by_x}), "s_x"),
            "s_slope": f"({-sw.HEAT_CAPACITY / 0.025**2!r}::double) / ((s_q + 273.15::double) * {poly([0.95, 0.05 / sw.SSO], 's_sa')})",
            **{f"s_a{j}": poly(sw.dense(row), "s_x") for j, row in surface.items()},
        },
    ]
    entropy = sw.dense({j: f"s_a{j}" for j in surface})
    slope = [f"(s_a{j} * {float(j)!r}::double)" for j in range(1, top + 1)]
    for _ in range(2):
        stages += [
            {"s_gap": f"{poly(entropy, 's_y')} - s_target"},
            {"s_middle": "s_y - (s_gap / s_slope) * 0.5::double"},
            {"s_slope": poly(slope, "s_middle")},
            {"s_y": "s_y - (s_gap / s_slope)"},
        ]
    enthalpy = sw.dense({i: poly(list(row), "s_y") for i, row in sw.ENTHALPY_ROWS.items()})
    result = f"{poly(enthalpy, 's_x')} * ({1 / sw.HEAT_CAPACITY!r}::double)"
    return steps(source, stages, [], result, "CONSERVATIVE_TEMP_COMPUTED")


def sigma1_sql(source: str, sa: str, ct: str) -> str:
    rows = sw.sigma1_rows()
    stages = [
        {"s_sa": f"cast({sa} AS double)", "s_ct": f"cast({ct} AS double)"},
        {"s_x": f"sqrt({poly([sw.SALINITY_OFFSET, sw.SALINITY_SCALE], 's_sa')})", "s_y": "s_ct * 0.025::double"},
        {f"s_v{j}": poly(row, "s_x") for j, row in enumerate(rows)},
        {"s_v": poly([f"s_v{j}" for j in range(len(rows))], "s_y")},
    ]
    return steps(source, stages, [], "1.0::double / s_v - 1000.0::double", "SIGMA1_COMPUTED")


def pressure_sql(source: str, depth: str, latitude: str) -> str:
    volume = sw.standard_volume_row()
    height = [0.0] + [1e8 * c / (j + 1) for j, c in enumerate(volume)]
    slope = [1e4 * c for c in volume]
    stages = [
        {"s_h": f"-cast({depth} AS double)", "s_sine": f"sin(radians(cast({latitude} AS double)))"},
        {"s_ss": "s_sine * s_sine"},
        {
            "s_g": f"{poly([1.0, 5.2792e-3, 2.32e-5], 's_ss')} * 9.780327::double",
            "s_c": poly([1 - 5.92e-3, -5.25e-3], "s_ss"),
        },
        {"s_p": "(s_h * -2.0::double) / (s_c + sqrt(s_c * s_c + s_h * 8.84e-6::double))"},
        {"s_gap": f"{poly(height, '(s_p * 1e-4::double)')} + s_h * s_g * {poly([1.0, -0.5 * 2.26e-7], 's_h')}"},
        {"s_middle": f"s_p - (s_gap / {poly(slope, '(s_p * 1e-4::double)')}) * 0.5::double"},
    ]
    result = f"s_p - (s_gap / {poly(slope, '(s_middle * 1e-4::double)')})"
    return steps(source, stages, [], result, "PRES")
