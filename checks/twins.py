"""The same queries in SQL that DuckDB runs over the driver's tables."""

from __future__ import annotations

import re

from checks import views as v
from obslake.vocab import lake_columns, parameters, raw_columns
from checks.seawater_sql import abs_salinity_sql, ct_sql, pressure_sql, sigma1_sql
from checks.seawater_tables import SSO

GOOD = "(1, 2, 5, 8)"
PARAMS = {"PHY": ["PRES", "TEMP", "PSAL"], "BGC": ["PRES", "TEMP", "PSAL", "DOXY", "CHLA_FLUORESCENCE"]}

CTES: dict[str, str] = {name: view.sql() for name, view in v.VIEWS.items()}


def mode_of(name: str, profile: str) -> str:
    return "DATA_MODE" if profile == "PHY" else f"{name}_DATA_MODE"


def gate(profile: str) -> str:
    tests = []
    for p in PARAMS[profile]:
        raw, adjusted = f"{p}_QC IN (1, 2)", f"{p}_ADJUSTED_QC IN (1, 2)"
        if profile == "BGC":
            raw += f" AND {p}_DATA_MODE = 'R'"
            adjusted += f" AND {p}_DATA_MODE IN ('A', 'D')"
        tests += [f"({raw})", f"({adjusted})"]
    return "(" + " OR ".join(tests) + ")"


def best(p: str, profile: str) -> str:
    mode = mode_of(p, profile)
    adjusted = f"{p}_ADJUSTED IS NOT NULL AND NOT isnan({p}_ADJUSTED) AND {p}_ADJUSTED_QC IN {GOOD} AND {mode} IN ('A', 'D')"
    raw = f"{p} IS NOT NULL AND NOT isnan({p}) AND {p}_QC IN {GOOD} AND {mode} = 'R'"
    return (
        f"CASE WHEN {adjusted} THEN {p}_ADJUSTED WHEN {raw} THEN {p} END AS {p}, "
        f"CASE WHEN {adjusted} THEN {p}_ADJUSTED_QC WHEN {raw} THEN {p}_QC END AS {p}_QC, "
        f"CASE WHEN {adjusted} THEN {p}_ADJUSTED_ERROR END AS {p}_ERROR"
    )


def best_values(profile: str, source: str) -> str:
    dropped = [
        p + suffix for p in PARAMS[profile] for suffix in ("", "_QC", "_ADJUSTED", "_ADJUSTED_QC", "_ADJUSTED_ERROR")
    ]
    listed = ", ".join(best(p, profile) for p in PARAMS[profile])
    return f"SELECT * EXCLUDE ({', '.join(dropped)}), {listed} FROM {source}"


LOCATED = f"POSITION_QC IN {GOOD} AND JULD_QC IN {GOOD}"


def located_only(profile: str, source: str) -> str:
    nulled = ", ".join(f"CASE WHEN {LOCATED} THEN {p} END AS {p}" for p in PARAMS[profile])
    return f"SELECT * REPLACE ({nulled}) FROM {source}"


def not_empty(profile: str) -> str:
    return f"coalesce({', '.join(PARAMS[profile])}) IS NOT NULL"


def domain(c: str) -> str:
    return f"CASE WHEN {c} IN ('R', 'A', 'D') THEN {c} END AS {c}"


def final(profile: str) -> str:
    known = [p for p in PARAMS[profile] if p != "CHLA_FLUORESCENCE"]
    modes = ["DATA_MODE"] if profile == "PHY" else [f"{p}_DATA_MODE" for p in known]
    values = ", ".join(f"{p}, {p}_QC, {p}_ERROR" for p in known)
    return (
        "SELECT 'ARGO' AS DB_NAME, cast(PLATFORM_NUMBER AS varchar) AS PLATFORM_NUMBER, LATITUDE, LONGITUDE, JULD, "
        f"{', '.join(domain(m) for m in modes)}, {values} "
        f"FROM located_{profile.lower()} WHERE {not_empty(profile)}"
    )


for _profile in ("PHY", "BGC"):
    _p = _profile.lower()
    CTES[f"gated_{_p}"] = f"SELECT * FROM obs_{_p} WHERE {gate(_profile)}"
    CTES[f"best_{_p}"] = best_values(_profile, f"gated_{_p}")
    CTES[f"located_{_p}"] = located_only(_profile, f"best_{_p}")
    CTES[f"argo_{_p}"] = final(_profile)

NULL_F, NULL_Q, NULL_S = "cast(NULL AS float)", "cast(NULL AS smallint)", "cast(NULL AS varchar)"

_bottle_keys = (
    "'GLODAP' AS DB_NAME, G2expocode AS PLATFORM_NUMBER, G2latitude AS LATITUDE, G2longitude AS LONGITUDE, "
    "make_timestamp(G2year, G2month, G2day, G2hour, G2minute, 0) AS JULD, "
    f"cast(G2pressure AS float) AS PRES, {NULL_Q} AS PRES_QC, {NULL_F} AS PRES_ERROR, "
    f"cast(G2temperature AS float) AS TEMP, {NULL_Q} AS TEMP_QC, {NULL_F} AS TEMP_ERROR, "
    f"cast(nullif(G2salinity, -9999) AS float) AS PSAL, cast(G2salinityf AS smallint) AS PSAL_QC, {NULL_F} AS PSAL_ERROR"
)
CTES["bottle_phy"] = f"SELECT {_bottle_keys} FROM src_bottle"
CTES["bottle_bgc"] = (
    f"SELECT {_bottle_keys}, cast(G2oxygen AS float) AS DOXY, cast(G2oxygenf AS smallint) AS DOXY_QC, "
    f"{NULL_F} AS DOXY_ERROR, cast(G2nitrate AS float) AS NITRATE, cast(G2nitratef AS smallint) AS NITRATE_QC, "
    f"{NULL_F} AS NITRATE_ERROR FROM src_bottle"
)
_plankton = "'CPR' AS DB_NAME, SampleId AS PLATFORM_NUMBER, Latitude AS LATITUDE, Longitude AS LONGITUDE"
CTES["plankton"] = f"SELECT {_plankton}, strptime(MidPoint_Date_UTC, '%Y-%m-%dT%H:%MZ') AS JULD FROM src_plankton"
CTES["plankton_parts"] = f"SELECT {_plankton}, make_timestamp(Year, Month, Day, Hour, 0, 0) AS JULD FROM src_plankton"
CTES["glider"] = (
    "SELECT 'SprayGliders' AS DB_NAME, mission_name AS PLATFORM_NUMBER, lat AS LATITUDE, lon AS LONGITUDE, "
    f"time AS JULD, PRES, cast(1 AS smallint) AS PRES_QC, {NULL_F} AS PRES_ERROR, "
    f"cast(temp AS float) AS TEMP, cast(1 AS smallint) AS TEMP_QC, {NULL_F} AS TEMP_ERROR, "
    f"cast(sal AS float) AS PSAL, cast(1 AS smallint) AS PSAL_QC, {NULL_F} AS PSAL_ERROR "
    f"FROM ({pressure_sql('src_glider', 'depth', 'lat')})"
)

PHY_COLUMNS = [
    "DB_NAME", "PLATFORM_NUMBER", "DATA_MODE", "LATITUDE", "LONGITUDE", "JULD",
    *[p + s for p in ("PRES", "TEMP", "PSAL") for s in ("", "_QC", "_ERROR")],
]
_HAS_VALUES = {"argo_phy", "bottle_phy", "glider"}


def padded(source: str, where: str = "", columns: list[str] = PHY_COLUMNS) -> str:
    """A source in the union's columns, with nulls for those it lacks."""
    absent = {} if source == "argo_phy" else {"DATA_MODE": NULL_S}
    if source not in _HAS_VALUES:
        absent |= {c: NULL_Q if c.endswith("_QC") else NULL_F for c in PHY_COLUMNS[6:]}
    listed = ", ".join(f"{absent[c]} AS {c}" if c in absent else c for c in columns)
    return f"SELECT {listed} FROM {source}" + (f" WHERE {where}" if where else "")


ALL_PHY = ["argo_phy", "bottle_phy", "glider", "plankton"]


def union(wheres: dict[str, str] | None = None, columns: list[str] = PHY_COLUMNS, sources: list[str] = ALL_PHY) -> str:
    wheres = wheres or {}
    return " UNION ALL ".join(padded(s, wheres.get(s, ""), columns) for s in sources)


CTES["lake_phy"] = union()

AND_WHERES = {
    s: "PSAL BETWEEN 31 AND 34.5 AND PRES > 150 AND LONGITUDE <> 0 AND TEMP_QC IN (1, 2, 5)" for s in ALL_PHY
} | {"plankton": "LONGITUDE <> 0"}
# Plankton has no measurements: only the group that it can answer is left.
OR_WHERES = {s: "(DB_NAME = 'CPR' AND LONGITUDE > 100) OR (PRES <= 400 AND PSAL < 32) OR TEMP < 4" for s in ALL_PHY} | {
    "plankton": "LONGITUDE > 100"
}
_MODE = "(DATA_MODE IN ('D', 'A') AND LATITUDE > 0) OR DATA_MODE = 'R'"
# The second group vanishes for sources without a mode; the first keeps its other half.
DISCARD_WHERES = {s: "LATITUDE > 0" for s in ALL_PHY} | {"argo_phy": _MODE}
NULL_WHERES = {s: "1 = 0" for s in ALL_PHY} | {"argo_phy": _MODE}
_NOT_IN = "(TEMP_QC IS NULL OR TEMP_QC NOT IN (1, 2)) AND PRES > 100"
NOT_IN_WHERES = {s: _NOT_IN for s in ALL_PHY} | {"plankton": ""}

RESET_COLUMNS = ["LONGITUDE", "PRES", "TEMP_QC", "PSAL"]
SELECT_COLUMNS = ["JULD", "DB_NAME", "TEMP", "DATA_MODE"]

# --- sizes --------------------------------------------------------------------------

_WIDTH = {c: 8 for c in ("LATITUDE", "LONGITUDE", "JULD")} | {
    p + s: w for p in ("PRES", "TEMP", "PSAL") for s, w in (("", 4), ("_QC", 2), ("_ERROR", 4))
}
SIZE_REPORT = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_null, "
    + (f"count(*) * {_WIDTH[c]}" if c in _WIDTH else f"cast(coalesce(sum(strlen({c})), 0) AS bigint)")
    + " AS n_bytes FROM lake_phy"
    for c in PHY_COLUMNS
)

# --- index --------------------------------------------------------------------------

_FILE = "^(([^/]*/[0-9]{7}/)profiles/)((?:R|D|SR|SD|BR|BD)([0-9]{7})_([0-9]{3,4})(?:D)?[.]nc)$"


def part(group: int) -> str:
    return f"nullif(regexp_extract(file, '{_FILE}', {group}), '')"


CTES["idx"] = (
    "SELECT file, try_strptime(date, '%Y%m%d%H%M%S') AS date, latitude, longitude, parameters, "
    "try_strptime(date_update, '%Y%m%d%H%M%S') AS date_update, "
    f"cast({part(4)} AS integer) AS wmoid, {part(2)} AS filepath_main, {part(1)} AS filepath, "
    f"{part(3)} AS filename, cast({part(5)} AS integer) AS cycle FROM profile_index"
)
def enriched(source: str) -> str:
    return CTES["idx"].replace("FROM profile_index", f"FROM {source}")


CTES["idx_before"] = enriched("profile_index_before")
CTES["idx_after"] = enriched("profile_index_after")
_PER_FILE = "SELECT file, any_value(filename) AS filename, any_value(wmoid) AS wmoid, any_value(filepath_main) AS filepath_main, max(date_update) AS latest, bool_or(date_update IS NULL) AS undated FROM idx_{} GROUP BY file"
CTES["file_before"], CTES["file_after"] = _PER_FILE.format("before"), _PER_FILE.format("after")
CTES["file_change"] = (
    "SELECT coalesce(o.file, n.file) AS file, coalesce(n.filename, o.filename) AS filename, coalesce(n.wmoid, o.wmoid) AS wmoid, "
    "coalesce(n.filepath_main, o.filepath_main) AS filepath_main, CASE WHEN o.file IS NULL THEN 'new' WHEN n.file IS NULL THEN 'withdrawn' "
    "WHEN o.latest IS DISTINCT FROM n.latest OR o.undated <> n.undated THEN 'reissued' END AS change, o.latest AS old_update, n.latest AS new_update "
    "FROM file_before o FULL JOIN file_after n ON o.file = n.file"
)
CTES["platform"] = "SELECT filepath_main, min_by(wmoid, file) AS wmoid FROM idx GROUP BY filepath_main"
CTES["stale"] = (
    "SELECT i.wmoid, i.latest_update, c.mtime, "
    "NOT coalesce(i.latest_update < c.mtime AND i.undated = 0, false) AS stale "
    "FROM (SELECT wmoid, max(date_update) AS latest_update, "
    "max(CASE WHEN date_update IS NULL THEN 1 ELSE 0 END) AS undated FROM idx GROUP BY wmoid) i "
    "LEFT JOIN local_inventory c ON i.wmoid = c.wmoid"
)


def plan(ending: str, url: str, root: str) -> str:
    return (
        f"SELECT p.filepath_main, p.wmoid, p.wmoid || '{ending}' AS file_name, '{url}' || p.filepath_main AS url, "
        f"'{root}' || p.filepath_main || p.wmoid || '{ending}' AS local_path, s.latest_update, s.mtime, s.stale "
        "FROM platform p LEFT JOIN stale s ON p.wmoid = s.wmoid"
    )


CTES["plan_bgc"] = plan("_Sprof.nc", "dac/", "gdac/")
CTES["due_bgc"] = "SELECT * EXCLUDE (stale) FROM plan_bgc WHERE stale"

# --- profiles -----------------------------------------------------------------------

CTES["levels"] = v.PROFILE_LEVELS_SQL
_PROFILE = (
    "concat('file_', cast(l_orderkey%997 as string)) AS input_file, cast(1000000+l_suppkey as bigint) AS PLATFORM_NUMBER, "
    "cast(l_orderkey as int) AS CYCLE_NUMBER, cast(l_linenumber as int) AS N_PROF"
)
_REASON = (
    "CASE WHEN l_orderkey%499=0 THEN 'parameters differ between calibrations' "
    "WHEN l_orderkey%991=1 THEN 'data mode longer than one letter' END"
)
CTES["profile"] = f"SELECT *, {_PROFILE}, {_REASON} AS reject_reason FROM lineitem"
CTES["bad_file"] = (
    "SELECT input_file, min(reject_reason) AS file_reason FROM profile WHERE reject_reason IS NOT NULL GROUP BY input_file"
)
_KEYS = "input_file, PLATFORM_NUMBER, CYCLE_NUMBER, N_PROF"
CTES["misfit_profile"] = (
    f"SELECT {_KEYS}, coalesce(reject_reason, CASE WHEN l_orderkey%883=5 "
    "THEN 'value that does not fit the type of its column' END) AS reason FROM profile"
)
CTES["named_profile"] = (
    "SELECT * REPLACE (CASE WHEN l_orderkey%5<>0 THEN input_file END AS input_file) FROM profile"
)
# Modes by position: PRES first, TEMP second or (listed twice) last, PSAL third.
_LIST = (
    "CASE WHEN l_orderkey%991=1 THEN ['R', '', 'A', 'R'] WHEN l_orderkey%3=0 THEN ['R', 'R', 'A', 'D'] "
    "WHEN l_orderkey%3=1 THEN ['A', 'A', 'R', 'A'] ELSE ['D', 'D', 'D', 'R'] END"
)
_MODE_OF = {
    "PRES": f"({_LIST})[1]",
    "TEMP": f"CASE WHEN l_orderkey%7=0 THEN ({_LIST})[4] ELSE ({_LIST})[2] END",
    "PSAL": f"({_LIST})[3]",
    "DOXY": "''",
}

# --- derived ------------------------------------------------------------------------

_DERIVED_KEYS = "PLATFORM_NUMBER, LATITUDE, LONGITUDE, JULD, PRES, TEMP, PSAL"


def with_derived(source: str) -> str:
    sa = abs_salinity_sql(source)
    ct = ct_sql(f"({sa})", "ABS_SAL_COMPUTED", "TEMP", "PRES")
    return sigma1_sql(f"({ct})", "ABS_SAL_COMPUTED", "CONSERVATIVE_TEMP_COMPUTED")


CTES["derived_argo"] = with_derived("argo_phy")

CTES["atlas_ratio"] = v.ATLAS_SQL
CTES["atlas_corner"] = (
    f"SELECT (cast((longitude - 1e0) / 30e0 AS integer) - e + {v.ATLAS_AROUND}) % {v.ATLAS_AROUND} AS i, "
    "cast((latitude + 90e0) / 30e0 AS integer) - u AS j, pressure, k, ratio "
    "FROM atlas_ratio, (VALUES (0, 0, 0), (1, 1, 0), (2, 0, 1), (3, 1, 1)) c(k, e, u)"
)
CTES["atlas_level"] = (
    "SELECT i, j, pressure, "
    + ", ".join(f"coalesce(max(ratio) FILTER (k = {k}), avg(ratio)) AS r{k}" for k in range(4))
    + " FROM atlas_corner GROUP BY i, j, pressure"
)
CTES["atlas_cell"] = (
    "SELECT i, j, list({'p': pressure, 'r0': r0, 'r1': r1, 'r2': r2, 'r3': r3} ORDER BY pressure) AS levels "
    "FROM atlas_level GROUP BY i, j"
)


def with_atlas(source: str) -> str:
    """A source's rows with absolute salinity that takes the regional ratio into account."""
    def on(level: str) -> str:
        south, north = (f"({level}.r{a} * (1e0 - u) + {level}.r{b} * u)" for a, b in ((0, 1), (2, 3)))
        return f"({south} * (1e0 - v) + {north} * v)"

    turned = "(LONGITUDE - 1e0) % 360e0"
    placed = f"SELECT *, (CASE WHEN {turned} < 0 THEN ({turned} + 360e0) % 360e0 ELSE {turned} END) / 30e0 AS east, (LATITUDE + 90e0) / 30e0 AS north FROM {source}"
    celled = "SELECT *, east - floor(east) AS u, north - floor(north) AS v FROM placed LEFT JOIN atlas_cell ON i = floor(east) AND j = floor(north)"
    held = "SELECT *, least(greatest(cast(PRES AS double), levels[1].p), levels[-1].p) AS held_p FROM celled"
    both = "SELECT *, list_filter(levels, lambda x: x.p <= held_p)[-1] AS lo, list_filter(levels, lambda x: x.p >= held_p)[1] AS hi FROM held"
    share = "SELECT *, CASE WHEN hi.p > lo.p THEN (held_p - lo.p) / (hi.p - lo.p) ELSE 0e0 END AS part FROM bracketed"
    ratio = f"coalesce({on('lo')} * (1e0 - part) + {on('hi')} * part, 0e0)"
    salinity = f"cast(cast(PSAL AS double) * ({SSO / 35!r}::double) * (1e0 + {ratio}) AS float) AS ABS_SAL_COMPUTED"
    return (
        f"WITH placed AS ({placed}), celled AS ({celled}), held AS ({held}), bracketed AS ({both}), shared AS ({share}) "
        f"SELECT * EXCLUDE (east, north, u, v, i, j, levels, held_p, lo, hi, part), {salinity} FROM shared"
    )


CTES["salt_argo"] = with_atlas("argo_phy")
CTES["salt_bottle"] = with_atlas("bottle_phy")
CTES["derived_bottle"] = with_derived("bottle_phy")

# What each source has of the BGC columns; the rest is null.
_BGC_HAS = {
    "argo_bgc": {
        "DB_NAME", "PLATFORM_NUMBER", "LATITUDE", "LONGITUDE", "JULD",
        *(f"{p}_DATA_MODE" for p in ("PRES", "TEMP", "PSAL", "DOXY")),
        *(p + x for p in ("PRES", "TEMP", "PSAL", "DOXY") for x in ("", "_QC", "_ERROR")),
    },
    "bottle_bgc": {
        "DB_NAME", "PLATFORM_NUMBER", "LATITUDE", "LONGITUDE", "JULD",
        *(p + x for p in ("PRES", "TEMP", "PSAL", "DOXY", "NITRATE") for x in ("", "_QC", "_ERROR")),
    },
    "plankton": {"DB_NAME", "PLATFORM_NUMBER", "LATITUDE", "LONGITUDE", "JULD"},
}


def typed_absence(column: str) -> str:
    """The null of an absent column, of the type its name says."""
    return NULL_Q if column.endswith("_QC") else NULL_S if column.endswith("_DATA_MODE") else NULL_F


def bgc_union(columns: list[str]) -> str:
    return " UNION ALL ".join(
        "SELECT " + ", ".join(c if c in has else f"{typed_absence(c)} AS {c}" for c in columns) + f" FROM {source}"
        for source, has in _BGC_HAS.items()
    )


_NANOS_MICROS = "((nanos - ((nanos % 1000) + 1000) % 1000) // 1000)"

def as_after(body: str) -> str:
    """Platform, staleness and plan over the index as issued next."""
    names = {"idx": "idx_after", "platform": "platform_after", "stale": "stale_after"}
    return re.sub(r"(FROM|JOIN) (idx|platform|stale)\b", lambda m: f"{m[1]} {names[m[2]]}", body)


CTES["platform_after"] = as_after(CTES["platform"])
CTES["stale_after"] = as_after(CTES["stale"])
_LATE = "date_trunc('hour', arrived) + INTERVAL 1 hour <= mark"
CTES["batch_mark"] = (
    "SELECT batch, max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 hours AS mark "
    "FROM (SELECT batch, max(arrived) AS latest FROM arrivals_in_batches GROUP BY batch)"
)
CTES["arrival"] = f"SELECT *, coalesce({_LATE}, false) AS late FROM arrivals_in_batches JOIN batch_mark USING (batch)"

def as_wanted(body: str) -> str:
    """Platform, staleness and plan over the part of the index that is wanted."""
    names = {"idx": "wanted_idx", "platform": "platform_wanted", "stale": "stale_wanted"}
    return re.sub(r"(FROM|JOIN) (idx|platform|stale)\b", lambda m: f"{m[1]} {names[m[2]]}", body)


CTES["wanted_idx"] = "SELECT * FROM idx WHERE latitude BETWEEN -30 AND 45.5 AND longitude BETWEEN -60 AND 20"
CTES["platform_wanted"] = as_wanted(CTES["platform"])
CTES["stale_wanted"] = as_wanted(CTES["stale"])
CTES["derived_argo_bgc"] = with_derived("argo_bgc")
CTES["derived_glider"] = with_derived("glider")

_UNCALIBRATED = "SELECT DISTINCT input_file FROM profile WHERE l_orderkey%499=0"
CTES["uncalibrated_file"] = _UNCALIBRATED
CTES["uncalibrated_rest"] = f"{_UNCALIBRATED} AND PLATFORM_NUMBER % 50 <> 3"
CTES["uncalibrated_wanted"] = f"{_UNCALIBRATED} AND PLATFORM_NUMBER + 900000 IN (SELECT wmoid FROM wanted_idx)"


def raw_table_sql(profile: str, where: str, more: str = "", number: str = "PLATFORM_NUMBER") -> str:
    """All columns of the raw table; those that the profiles do not have are nulls of the type their name says."""
    made = {
        "PLATFORM_NUMBER": f"{number} AS PLATFORM_NUMBER", "N_LEVELS": "cast(i AS integer) AS N_LEVELS",
        **{c: c for c in ("N_PROF", "CYCLE_NUMBER", "LATITUDE", "LONGITUDE", "JULD")},
        **{p: f"cast({p} AS float) AS {p}" for p in PARAMS["PHY"]},
    }
    if profile == "BGC":
        made |= {f"{n}_DATA_MODE": f"{_MODE_OF.get(n, chr(39) * 2)} AS {n}_DATA_MODE" for n in parameters("BGC", raw=True)}
    listed = [made.get(c, f"{typed_absence(c)} AS {c}") for c in raw_columns(profile)] + ([more] if more else [])
    return f"SELECT {', '.join(listed)} FROM levels WHERE {where}"


BODIES: dict[str, str] = {
    "stream_hourly_closed": "SELECT hour, CASE WHEN n > 0 THEN n_ok END AS n_ok, CASE WHEN n > 0 THEN n - n_ok END AS n_failed, n_late, "
    "CASE WHEN n > 0 THEN hour + INTERVAL 1 hour <= (SELECT max(arrived) - INTERVAL 2 hours FROM arrival) END AS closed FROM "
    "(SELECT date_trunc('hour', arrived) AS hour, count(*) FILTER (WHERE NOT late) AS n, "
    "count(*) FILTER (WHERE NOT late AND NOT failed) AS n_ok, nullif(count(*) FILTER (WHERE late), 0) AS n_late FROM arrival GROUP BY 1)",
    "stream_latest_compacted": "SELECT file, max(date_update) AS date_update, "
    "max_by(version, (date_update, version)) AS version FROM reissued GROUP BY file",
    "stream_group_std": "SELECT PLATFORM_NUMBER, round(stddev_samp(cast(PSAL AS double)), 6) AS std FROM argo_phy GROUP BY PLATFORM_NUMBER",
    "ingest_stream_restarted": "SELECT * FROM argo_phy",
    "index_changes": "SELECT * REPLACE (CASE WHEN change IN ('new', 'withdrawn') AND filename IN (SELECT filename FROM file_change WHERE change = 'new') "
    "AND filename IN (SELECT filename FROM file_change WHERE change = 'withdrawn') THEN 'moved' ELSE change END AS change) "
    "FROM file_change WHERE change IS NOT NULL",
    "fetch_plan_delta": as_after(plan("_Sprof.nc", "dac/", "gdac/")),
    "index_staleness_as_of": "SELECT c.wmoid, t.moment, max(i.date_update) FILTER (i.date_update <= t.moment) AS latest_update, "
    "max_by(i.file, (i.date_update, i.file)) FILTER (i.date_update <= t.moment) AS latest_file, c.mtime, "
    "NOT coalesce(max(i.date_update) FILTER (i.date_update <= t.moment) < c.mtime AND NOT bool_or(i.date_update IS NULL), false) AS stale "
    "FROM local_inventory c CROSS JOIN (VALUES (timestamp '2002-01-01'), (timestamp '2003-06-15 06:00:00'), (timestamp '2004-06-15 05:59:59'), "
    "(timestamp '2001-01-01')) t(moment) LEFT JOIN idx i ON i.wmoid = c.wmoid GROUP BY c.wmoid, t.moment, c.mtime",
    "profile_data_mode_long": f"SELECT {_KEYS}, " + ", ".join(f"{e} AS {n}_DATA_MODE" for n, e in _MODE_OF.items()) + " FROM profile",
    "derived_abs_salinity_atlas": f"SELECT {_DERIVED_KEYS}, ABS_SAL_COMPUTED FROM salt_argo",
    "job_bottle_phy_atlas": sigma1_sql(f"({ct_sql('salt_bottle', 'ABS_SAL_COMPUTED', 'TEMP', 'PRES')})", "ABS_SAL_COMPUTED", "CONSERVATIVE_TEMP_COMPUTED"),
    "qc_row_gate_phy": "SELECT * FROM gated_phy",
    "qc_row_gate_bgc": "SELECT * FROM gated_bgc",
    "qc_best_value_phy": best_values("PHY", "obs_phy"),
    "qc_best_value_bgc": best_values("BGC", "obs_bgc"),
    "qc_position_time_gate": located_only("PHY", "obs_phy"),
    "qc_drop_empty_rows": f"SELECT * FROM ({located_only('PHY', '(' + best_values('PHY', 'obs_phy') + ')')}) WHERE {not_empty('PHY')}",
    "qc_best_value_table_phy": "SELECT * FROM argo_phy",
    "qc_best_value_table_bgc": "SELECT * FROM argo_bgc",
    "qc_platform_summary": "SELECT PLATFORM_NUMBER, count(*) AS n_rows, "
    + ", ".join(
        f"count({p}) AS n_{p.lower()}, round(avg(cast({p} AS double)), 6) AS mean_{p.lower()}" for p in PARAMS["PHY"]
    )
    + " FROM argo_phy GROUP BY PLATFORM_NUMBER",
    "qc_constant_flags": "SELECT profile, depth, lat, lon, time, mission_name, temp AS TEMP, sal AS PSAL, "
    "cast(1 AS smallint) AS TEMP_QC, cast(2 AS smallint) AS PSAL_QC FROM src_glider",
    "std_bottle_phy": "SELECT * FROM bottle_phy",
    "std_bottle_bgc": "SELECT * FROM bottle_bgc",
    "std_plankton": "SELECT * FROM plankton",
    "std_plankton_parts": "SELECT * FROM plankton_parts",
    "std_glider": "SELECT * FROM glider",
    "trim_bgc_to_phy": "SELECT DB_NAME, PLATFORM_NUMBER, LATITUDE, LONGITUDE, JULD, "
    + ", ".join(f"{p}, {p}_QC, {p}_ERROR" for p in PARAMS["PHY"])
    + " FROM argo_bgc",
    "domain_check": "SELECT PLATFORM_NUMBER, CYCLE_NUMBER, N_LEVELS, CASE WHEN DIRECTION IN ('A', 'D') THEN DIRECTION END AS DIRECTION, "
    "CASE WHEN N_LEVELS <= 3 THEN 'ARGO' END AS DB_NAME, "
    + ", ".join(domain(f"{p}_DATA_MODE") for p in PARAMS["BGC"])
    + " FROM obs_bgc",
    "null_normalise": "SELECT key, CASE WHEN isnan(TEMP) OR TEMP = -9999 THEN NULL ELSE TEMP END AS TEMP, "
    "CASE WHEN isnan(PSAL) OR PSAL = -9999 THEN NULL ELSE PSAL END AS PSAL FROM messy",
    "reindex_raw_phy": "SELECT *, cast(NULL AS integer) AS N_PROF FROM obs_phy",
    "cast_lenient": "SELECT key, CASE WHEN TEMP_QC BETWEEN 0 AND 255 THEN cast(TEMP_QC AS smallint) END AS TEMP_QC, "
    "try_cast(PRES AS float) AS PRES FROM messy",
    "add_null_companions": "SELECT G2expocode AS PLATFORM_NUMBER, G2latitude AS LATITUDE, G2longitude AS LONGITUDE, "
    "G2pressure AS PRES, G2temperature AS TEMP, G2salinity AS PSAL, G2salinityf AS PSAL_QC, G2oxygen AS DOXY, "
    "G2oxygenf AS DOXY_QC, G2nitrate AS NITRATE, G2nitratef AS NITRATE_QC, "
    f"{NULL_Q} AS PRES_QC, {NULL_Q} AS TEMP_QC, "
    + ", ".join(f"{NULL_F} AS {p}_ERROR" for p in ("PRES", "TEMP", "PSAL", "DOXY", "NITRATE"))
    + " FROM src_bottle",
    "parse_times": "SELECT key, CASE WHEN month BETWEEN 1 AND 12 AND month NOT IN (2, 4, 6, 9, 11) "
    "THEN make_timestamp(1999, month, 31, 0, 0, 0) END AS from_parts, "
    "try_strptime(iso, '%Y-%m-%dT%H:%MZ') AS from_iso, try_strptime(compact, '%Y%m%d%H%M%S') AS from_compact, "
    f"make_timestamp({_NANOS_MICROS}) AS from_nanos FROM messy",
    "lake_union": "SELECT * FROM lake_phy",
    "lake_union_bgc": bgc_union(lake_columns("BGC")),
    "lake_union_select": union(columns=SELECT_COLUMNS, sources=["argo_phy", "plankton"]),
    "lake_filter_and": union(AND_WHERES),
    "lake_filter_or": union(OR_WHERES),
    "lake_filter_missing_discard": union(DISCARD_WHERES),
    "lake_filter_missing_null": union(NULL_WHERES),
    "lake_filter_not_in": union(NOT_IN_WHERES),
    "lake_filter_reset": union(AND_WHERES, RESET_COLUMNS),
    "lake_size_report": SIZE_REPORT,
    "lake_head": "SELECT * FROM lake_phy ORDER BY "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in ["JULD", "PLATFORM_NUMBER", *[c for c in PHY_COLUMNS if c not in ("JULD", "PLATFORM_NUMBER")]])
    + " LIMIT 100",
    "lake_tail": "SELECT * FROM lake_phy ORDER BY "
    + ", ".join(f"{c} DESC NULLS LAST" for c in ["JULD", "PLATFORM_NUMBER", *[c for c in PHY_COLUMNS if c not in ("JULD", "PLATFORM_NUMBER")]])
    + " LIMIT 100",
    "lake_group_std": "SELECT LATITUDE, round(stddev_samp(LONGITUDE), 6) AS std FROM lake_phy GROUP BY LATITUDE",
    "index_enrich": "SELECT * FROM idx",
    "index_box": "SELECT * FROM idx WHERE latitude BETWEEN -30 AND 45.5 AND longitude BETWEEN -60 AND 20 "
    "AND date BETWEEN timestamp '1994-01-01' AND timestamp '1997-06-01 12:00:00'",
    "index_dateline": f"SELECT * FROM idx WHERE latitude BETWEEN 0 AND 60 AND (longitude >= 170 OR longitude <= -170)",
    "index_platforms": f"SELECT * FROM idx WHERE wmoid IN (1900007, 1900010, 1900101)",
    "index_platforms_from_table": f"SELECT * FROM idx WHERE wmoid IN "
    "(SELECT wmoid FROM local_inventory WHERE mtime < timestamp '2004-01-01')",
    "index_no_range": "SELECT * FROM idx",
    "index_sensors": f"SELECT * FROM idx WHERE list_contains(string_split(parameters, ' '), 'DOXY') "
    f"AND list_contains(string_split(parameters, ' '), 'CHLA')",
    "index_sensors_contains": f"SELECT * FROM idx WHERE contains(parameters, 'CHLA')",
    "index_rejects": "SELECT upper(file) AS file, date, cast(NULL AS integer) AS wmoid, cast(NULL AS integer) AS cycle "
    "FROM idx WHERE ends_with(parameters, 'CHLA')",
    "index_unique_platforms": "SELECT * FROM platform",
    "index_staleness": "SELECT * FROM stale",
    "fetch_plan": "SELECT * FROM due_bgc",
    "fetch_plan_profiles": "SELECT file, wmoid, filename AS file_name, 'dac/' || filepath AS url, "
    f"'gdac/' || filepath || filename AS local_path FROM idx WHERE list_contains(string_split(parameters, ' '), 'DOXY')",
    "fetch_actions": "SELECT filepath_main, CASE WHEN mtime IS NULL THEN 'fetch' WHEN latest_update > mtime THEN 'overwrite' "
    "ELSE 'skip_fresh' END AS action, CASE WHEN mtime IS NULL THEN 'fetch' ELSE 'skip_exists' END AS action_keep, "
    "CASE WHEN mtime IS NULL THEN 'fetch' ELSE 'overwrite' END AS action_force FROM plan_bgc",
    "fetch_batches": "SELECT filepath_main, cast(floor((row_number() OVER (ORDER BY filepath_main) - 1) / "
    "ceil((count(*) OVER ()) / least(36.0, count(*) OVER ()))) AS integer) AS batch_id FROM due_bgc",
    "fetch_batches_many": "SELECT filepath_main, cast(floor((row_number() OVER (ORDER BY filepath_main) - 1) / "
    "ceil((count(*) OVER ()) / least(200.0, count(*) OVER ()))) AS integer) AS batch_id FROM due_bgc",
    "load_failures": "SELECT input_file FROM manifest WHERE input_file NOT IN (SELECT input_file FROM loaded)",
    "load_failure_summary": "SELECT count(*) AS n_inputs, count(*) FILTER (WHERE NOT hit) AS n_failed, "
    "count(*) FILTER (WHERE NOT hit) * 100e0 / count(*) AS failed_percent "
    "FROM (SELECT input_file IN (SELECT input_file FROM loaded) AS hit FROM manifest)",
    "profile_flatten": "SELECT PLATFORM_NUMBER, CYCLE_NUMBER, N_PROF, LATITUDE, LONGITUDE, JULD, "
    "cast(i AS integer) AS N_LEVELS, PRES, TEMP, PSAL FROM levels",
    "profile_data_mode": f"SELECT {_KEYS}, " + ", ".join(f"{e} AS {n}_DATA_MODE" for n, e in _MODE_OF.items()) + " FROM profile",
    "profile_calibration_check": f"SELECT {_KEYS}, l_orderkey%499<>0 AS same_parameters FROM profile",
    "profile_rejects": f"SELECT {_KEYS}, reject_reason FROM profile WHERE reject_reason IS NOT NULL",
    "profile_rejects_by_file": f"SELECT {_KEYS.replace('input_file', 'p.input_file')}, b.file_reason AS reject_reason "
    "FROM profile p JOIN bad_file b ON p.input_file = b.input_file",
    "profile_rejects_bad_values": f"SELECT {_KEYS}, min(reason) OVER (PARTITION BY input_file) AS reject_reason FROM misfit_profile",
    "profile_rejects_null_file": f"SELECT {_KEYS}, CASE WHEN input_file IS NULL THEN reject_reason "
    "ELSE min(reject_reason) OVER (PARTITION BY input_file) END AS reject_reason FROM named_profile",
    "profile_unknown_parameters": "SELECT 'MTIME' AS parameter, count(*) AS n_profiles FROM lineitem WHERE l_orderkey%7<>0 HAVING count(*) > 0",
    "profile_raw_table": raw_table_sql("BGC", "input_file NOT IN (SELECT input_file FROM bad_file)"),
    "derived_abs_salinity": f"SELECT {_DERIVED_KEYS}, ABS_SAL_COMPUTED FROM derived_argo",
    "derived_ct": f"SELECT {_DERIVED_KEYS}, CONSERVATIVE_TEMP_COMPUTED FROM derived_argo",
    "derived_sigma1": f"SELECT {_DERIVED_KEYS}, SIGMA1_COMPUTED FROM derived_argo",
    "derived_pressure": f"SELECT profile, time, depth, lat, PRES FROM ({pressure_sql('src_glider', 'depth', 'lat')})",
    "job_argo_phy": "SELECT * FROM derived_argo",
    "job_bottle_phy": "SELECT * FROM derived_bottle",
    "scan_filtered": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
    "WHERE (l_quantity < 10 AND l_returnflag IN ('R', 'A')) OR l_discount > 0.09",
    "sink_roundtrip": "SELECT * FROM argo_phy",
    "sink_append_fewer_columns": "SELECT * FROM derived_argo WHERE LATITUDE < 0 UNION ALL "
    f"SELECT *, {NULL_F}, {NULL_F}, {NULL_F} FROM argo_phy WHERE LATITUDE >= 0",
    "job_bottle_append": "SELECT b.*, 2 * (SELECT count(*) FROM derived_bottle) AS n_bgc "
    "FROM (SELECT * FROM derived_bottle UNION ALL SELECT * FROM derived_bottle) b",
    "job_raw_append": "SELECT PLATFORM_NUMBER, nullif(sum(CASE WHEN l_orderkey%499<>0 THEN l_linenumber ELSE 0 END), 0)::bigint AS n_levels, "
    "nullif(count(*) FILTER (WHERE l_orderkey%499=0), 0) AS n_rejects FROM profile GROUP BY PLATFORM_NUMBER",
    "lake_from_disk": union(OR_WHERES),
    "csv_roundtrip": "SELECT * FROM bottle_phy",
    "job_raw_profiles": raw_table_sql("PHY", "input_file NOT IN (SELECT input_file FROM uncalibrated_file)"),
    "job_corrupt_file": raw_table_sql(
        "PHY", "PLATFORM_NUMBER % 50 <> 3 AND input_file NOT IN (SELECT input_file FROM uncalibrated_rest)", "1::bigint AS n_files, 'not a whole Parquet file' AS file_reason"
    ),
    "csv_rejects": "SELECT CASE WHEN Latitude = 'north' THEN regexp_extract(SampleId, '^[0-9]+DA') ELSE SampleId END AS SampleId, "
    "try_cast(Latitude AS double) AS Latitude, CASE WHEN Latitude <> 'north' THEN Longitude END AS Longitude, "
    "CASE WHEN Latitude <> 'north' THEN MidPoint_Date_UTC END AS MidPoint_Date_UTC, CASE WHEN Latitude <> 'north' THEN cast(Chlorophyll_Index AS varchar) END AS Chlorophyll_Index, "
    "CASE WHEN Latitude = 'north' THEN 'malformed' END AS reason, "
    "CASE WHEN Latitude = 'north' THEN cast(length(SampleId) - length(replace(SampleId, chr(10), '')) AS integer) END AS n_breaks FROM plankton_lines",
    "job_argo_bgc": "SELECT * FROM derived_argo_bgc",
    "job_glider": "SELECT * FROM derived_glider",
    "job_plankton": "SELECT *, 'PHY' AS profile FROM plankton UNION ALL SELECT *, 'BGC' AS profile FROM plankton",
    "convert_many_files": "SELECT * FROM bottle_bgc",
    "job_index_to_raw": raw_table_sql(
        "PHY", "input_file NOT IN (SELECT input_file FROM uncalibrated_wanted) AND PLATFORM_NUMBER + 900000 IN (SELECT wmoid FROM wanted_idx)", number="PLATFORM_NUMBER + 900000"
    ),
    "job_index_plan": "SELECT * EXCLUDE (stale) FROM (" + as_wanted(plan("_prof.nc", "dac/", "gdac/")) + ") WHERE stale",
    "index_metadata": "SELECT * FROM wanted_idx",
    "index_text": "SELECT * FROM idx",
    "ingest_stream": "SELECT * FROM argo_phy",
    "stream_latest_index": "SELECT file, max(date_update) AS date_update, "
    "max_by(version, (date_update, version)) AS version FROM reissued GROUP BY file",
    "stream_load_report": "SELECT date_trunc('hour', arrived) AS hour, count(*) FILTER (WHERE NOT failed) AS n_ok, "
    "count(*) FILTER (WHERE failed) AS n_failed FROM arrivals GROUP BY 1",
}


def _needed(body: str, seen: list[str]) -> list[str]:
    for name in CTES:
        if name not in seen and re.search(rf"(?:FROM|JOIN) {name}\b", body):
            _needed(CTES[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def statement(body: str) -> str:
    names = _needed(body, [])
    return (f"WITH {', '.join(f'{n} AS ({CTES[n]})' for n in names)} " if names else "") + body


TWINS = {name: statement(body) for name, body in BODIES.items()}
