"""Observation tables derived from the driver's tables.

The driver's tables hold no ocean data. Each view maps rows of one of them to the form of
a source table, by expressions that mean the same in Spark SQL and in DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class View:
    table: str
    columns: dict[str, str]
    where: str = ""

    def sql(self) -> str:
        listed = ", ".join(f'{e} AS "{c}"' for c, e in self.columns.items())
        return f"SELECT {listed} FROM {self.table}" + (f" WHERE {self.where}" if self.where else "")

    def read(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        return self.over(df)

    def over(self, df: DataFrame) -> DataFrame:
        df = df.where(self.where) if self.where else df
        return df.selectExpr(*[f"{e} AS `{c}`" for c, e in self.columns.items()])


MODE = "case when l_returnflag='N' then 'D' else l_returnflag end"
IS_R = "l_returnflag='R'"


def block(name: str, value: str, flag: str, no_adjusted: str, add: str, adjusted_flag: str, error: str) -> dict[str, str]:
    """Value, flag, adjusted value, adjusted flag and error of one parameter."""
    return {
        name: f"cast({value} as float)",
        f"{name}_QC": f"cast({flag} as smallint)",
        f"{name}_ADJUSTED": f"cast(case when {no_adjusted} then null else {value}+{add} end as float)",
        f"{name}_ADJUSTED_QC": f"cast(case when {IS_R} then null else {adjusted_flag} end as smallint)",
        f"{name}_ADJUSTED_ERROR": f"cast(case when {IS_R} then null else {error} end as float)",
    }


_KEYS = {
    "PLATFORM_NUMBER": "cast(1000000+l_suppkey as bigint)",
    "CYCLE_NUMBER": "cast(l_orderkey as int)",
    "N_LEVELS": "cast(l_linenumber as int)",
    "DIRECTION": "case when l_linestatus='O' then 'A' else 'D' end",
    "LATITUDE": "cast((l_partkey*37)%18001 as double)/100e0-90e0",
    "LONGITUDE": "cast((l_suppkey*73+l_orderkey*11)%36000 as double)/100e0-180e0",
    "POSITION_QC": "cast(case when l_orderkey%11=0 then 4 when l_orderkey%5=0 then 8 else 1 end as smallint)",
    "JULD": "l_shipdate",
    "JULD_QC": "cast(case when l_orderkey%13=0 then 3 when l_orderkey%7=0 then 5 else 1 end as smallint)",
}
_PRES = block("PRES", "l_quantity*40e0", "1+l_partkey%4", IS_R, "1e0", "1+l_suppkey%5", "2.5e0")
_TEMP = block(
    "TEMP", "(case when l_partkey%17=0 then cast('NaN' as double) else l_discount*256e0 end)", "1+(l_partkey+l_linenumber)%8", f"{IS_R} or l_linenumber=7", "0.5e0",
    "1+(l_suppkey+l_linenumber)%9", "0.25e0",
)
_PSAL = block(
    "PSAL", "30e0+l_tax*64e0", "1+l_orderkey%9", IS_R, "0.125e0", "1+(l_orderkey+l_partkey)%6", "0.125e0"
)
_DOXY = block(
    "DOXY", "cast(l_partkey%400 as double)", "1+l_suppkey%9", IS_R, "4e0", "1+(l_partkey+l_suppkey)%9", "8e0"
)
_CHLF = block(
    "CHLA_FLUORESCENCE", "cast(l_suppkey%16 as double)", "1+l_orderkey%2", IS_R, "1e0", "1", "0.5e0"
)

OBS_PHY = View("lineitem", {**_KEYS, "DATA_MODE": MODE, **_PRES, **_TEMP, **_PSAL})

OBS_BGC = View(
    "lineitem",
    {
        **_KEYS, **_PRES, **_TEMP, **_PSAL, **_DOXY, **_CHLF,
        "PRES_DATA_MODE": MODE,
        "TEMP_DATA_MODE": MODE,
        "PSAL_DATA_MODE": f"case when l_linestatus='O' then 'R' else {MODE} end",
        "DOXY_DATA_MODE": f"case when l_partkey%5=0 then null else {MODE} end",
        "CHLA_FLUORESCENCE_DATA_MODE": f"case when l_orderkey%4=0 then {MODE} else '' end",
    },
)

_ORDER_LATITUDE = "cast((o_custkey*37)%18001 as double)/100e0-90e0"
_ORDER_LONGITUDE = "cast((o_orderkey*73)%36000 as double)/100e0-180e0"

SRC_BOTTLE = View(
    "orders",
    {
        "G2expocode": "concat('EX', cast(o_custkey as string))",
        "G2year": "cast(year(o_orderdate) as int)",
        "G2month": "cast(month(o_orderdate) as int)",
        "G2day": "cast(day(o_orderdate) as int)",
        "G2hour": "cast(o_orderkey%24 as int)",
        "G2minute": "cast(o_orderkey%60 as int)",
        "G2latitude": _ORDER_LATITUDE,
        "G2longitude": _ORDER_LONGITUDE,
        "G2pressure": "cast(o_orderkey%4000 as double)",
        "G2temperature": "cast(o_orderkey%256 as double)/8e0",
        "G2salinity": "case when o_orderkey%9=0 then -9999e0 else 32e0+cast(o_custkey%64 as double)/16e0 end",
        "G2salinityf": "cast(case o_orderkey%3 when 0 then 0 when 1 then 2 else 9 end as int)",
        "G2oxygen": "case when o_orderkey%10=0 then null else 100e0+cast(o_orderkey%200 as double) end",
        "G2oxygenf": "cast(case when o_orderkey%10=0 then 9 else 2 end as int)",
        "G2nitrate": "cast(o_custkey%40 as double)/4e0",
        "G2nitratef": "2",
        "G2region": "cast(o_orderkey%5 as double)",
    },
)

SRC_PLANKTON = View(
    "part",
    {
        "SampleId": "concat(cast(p_partkey as string),'DA-',cast(p_size as string))",
        "Latitude": "cast((p_partkey*41)%18001 as double)/100e0-90e0",
        "Longitude": "cast((p_partkey*67)%36000 as double)/100e0-180e0",
        "MidPoint_Date_UTC": "concat(cast(1958+p_partkey%60 as string),'-',lpad(cast(1+p_partkey%12 as string),2,'0'),'-',"
        "lpad(cast(1+p_partkey%28 as string),2,'0'),'T',lpad(cast(p_partkey%24 as string),2,'0'),':',"
        "lpad(cast(p_partkey%60 as string),2,'0'),'Z')",
        "Year": "cast(1958+p_partkey%60 as int)",
        "Month": "cast(1+p_partkey%12 as int)",
        "Day": "cast(1+p_partkey%28 as int)",
        "Hour": "cast(p_partkey%24 as int)",
        "Chlorophyll_Index": "cast(p_size as double)",
    },
)

# Plankton samples whose names go over three lines, and some whose latitude is no number.
PLANKTON_LINES = View(
    "part",
    {
        **SRC_PLANKTON.columns,
        "SampleId": "case when p_partkey%10=0 then concat(cast(p_partkey as string),'DA',chr(10),'second, line',chr(10),cast(p_size as string)) "
        "else concat(cast(p_partkey as string),'DA-',cast(p_size as string)) end",
        "Latitude": "case when p_partkey%17=0 then 'north' else cast((p_partkey*41)%181-90 as string) end",
    },
)

SRC_GLIDER = View(
    "events",
    {
        "profile": "cast(user_id as int)",
        "depth": "value*8e0",
        "lat": "cast((event_id*29)%18001 as double)/100e0-90e0",
        "lon": "cast((event_id*53)%36000 as double)/100e0-180e0",
        "time": "ts",
        "mission_name": "event_type",
        "temp": "cast(event_id%128 as double)/4e0",
        "sal": "33e0+cast(event_id%32 as double)/16e0",
    },
)

PROFILE_INDEX = View(
    "orders",
    {
        "file": "concat(case o_custkey%3 when 0 then 'aoml' when 1 then 'coriolis' else 'bodc' end,'/',"
        "cast(1900000+o_custkey as string),'/profiles/',case when o_orderstatus='F' then 'SD' else 'SR' end,"
        "cast(1900000+o_custkey as string),'_',lpad(cast(o_orderkey%1000 as string),3,'0'),"
        "case when o_orderkey%17=0 then 'D' else '' end,'.nc')",
        "date": "case when o_orderkey%13=0 then '' else concat(cast(year(o_orderdate) as string),lpad(cast(month(o_orderdate) as string),2,'0'),"
        "lpad(cast(day(o_orderdate) as string),2,'0'),'120000') end",
        "latitude": f"case when o_orderkey%19=0 then null else {_ORDER_LATITUDE} end",
        "longitude": _ORDER_LONGITUDE,
        "parameters": "concat('PRES TEMP PSAL',case when o_orderkey%2=0 then ' DOXY' else '' end,"
        "case when o_orderkey%3=0 then ' CHLA' else '' end,"
        "case when o_orderkey%5=0 then ' CHLA_FLUORESCENCE' else '' end)",
        "date_update": "case when o_orderkey%2111=0 then '' else concat(cast(2001+o_orderkey%5 as string),"
        "lpad(cast(1+o_orderkey%12 as string),2,'0'),'15060000') end",
    },
)

LOCAL_INVENTORY = View(
    "customer",
    {
        "wmoid": "cast(1900000+c_custkey as bigint)",
        "mtime": "case when c_custkey%4<>0 then cast(concat(cast(2001+c_custkey%6 as string),'-07-01 00:00:00') as timestamp) end",
    },
)

# One profile per row with 1 to 7 levels; the salinity array is one level short.
_LEVELS = {
    "PRES": "l_quantity*40e0+cast({i} as double)*5e0",
    "TEMP": "l_discount*256e0-cast({i} as double)*0.5e0",
    "PSAL": "30e0+l_tax*64e0+cast({i} as double)*0.125e0",
}
_PROFILE_KEYS = {
    "input_file": "concat('file_', cast(l_orderkey%997 as string))",
    "PLATFORM_NUMBER": _KEYS["PLATFORM_NUMBER"],
    "N_PROF": "cast(l_linenumber as int)",
    "CYCLE_NUMBER": _KEYS["CYCLE_NUMBER"],
    "LATITUDE": _KEYS["LATITUDE"],
    "LONGITUDE": _KEYS["LONGITUDE"],
    "JULD": "l_shipdate",
}
PROFILE_LISTS = {
    "PARAMETER": "case when l_orderkey%7=0 then array('PRES','TEMP','PSAL','TEMP') else array('PRES','TEMP  ','PSAL','MTIME') end",
    "PARAMETER_DATA_MODE": "case when l_orderkey%991=1 then array('R','RA','A','R') when l_orderkey%3=0 then array('R','R','A','D') "
    "when l_orderkey%3=1 then array('A','A','R','A') else array('D','D ',' D','R') end",
    "CALIBRATION_PARAMETERS": "case when l_orderkey%499=0 then array(array('PRES'),array('TEMP')) "
    "else array(array('PRES'),array('PRES')) end",
}


def profile_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = {
        name: f"transform(sequence(0, l_linenumber-{2 if name == 'PSAL' else 1}), i -> {e.format(i='i')})"
        for name, e in _LEVELS.items()
    }
    lists["PSAL"] = f"case when l_linenumber<2 then cast(array() as array<double>) else {lists['PSAL']} end"
    return View("lineitem", {**_PROFILE_KEYS, **lists, **PROFILE_LISTS}).read(spark, sf_dir)


PROFILE_LEVELS_SQL = (
    "SELECT *, "
    + ", ".join(
        (f"case when i >= l_linenumber-1 then null else {e.format(i='i')} end" if n == "PSAL" else e.format(i="i")) + f' AS "{n}"'
        for n, e in _LEVELS.items()
    )
    + ", "
    + ", ".join(f'{e} AS "{n}"' for n, e in _PROFILE_KEYS.items())
    + " FROM (SELECT *, unnest(range(l_linenumber)) AS i FROM lineitem)"
)

# Text and numbers to be parsed or cast, some of them bad.
MESSY = View(
    "lineitem",
    {
        "key": "l_orderkey*10+l_linenumber",
        "month": "cast(l_partkey%15 as int)",
        "iso": "case when l_partkey%11=0 then 'none' else concat('1999-',lpad(cast(1+l_partkey%12 as string),2,'0'),'-15T07:30Z') end",
        "compact": "case when l_suppkey%5=0 then '' else concat('2003',lpad(cast(1+l_suppkey%14 as string),2,'0'),'15060000') end",
        "nanos": "(l_orderkey-30000)*1000000007+l_partkey",
        "TEMP": "case when l_partkey%7=0 then cast('NaN' as double) when l_partkey%7=1 then -9999e0 else l_discount*256e0 end",
        "PSAL": "cast(case when l_suppkey%3=0 then cast('NaN' as double) else 30e0+l_tax*64e0 end as float)",
        "TEMP_QC": "cast(l_orderkey%300-20 as int)",
        "PRES": "case when l_partkey%13=0 then 'bad' else cast(cast(l_quantity as int) as string) end",
    },
)

# Files of an index that is issued again and again: an entry per order, several per file.
REISSUED = View(
    "orders",
    {
        "file": "concat('aoml/',cast(o_custkey as string),'/profiles/R',cast(o_custkey as string),'_',lpad(cast(o_orderkey%7 as string),3,'0'),'.nc')",
        "date_update": "o_orderdate",
        "version": "o_orderkey",
    },
)

# Outcomes by the batch they arrive in: some come two batches late.
ARRIVALS_IN_BATCHES = View(
    "events",
    {
        "arrived": "ts",
        "failed": "event_id%9=0",
        "batch": "least(9, cast(floor((dayofmonth(ts)-1)/3e0) as int)+case when event_id%23=0 then 2 else 0 end)",
    },
)

# The index as it is issued next: entries gone, moved to another data centre and issued again.
_NEXT_FILE = PROFILE_INDEX.columns["file"].replace("case o_custkey%3 when", "case (o_custkey+case when o_custkey%30=0 then 1 else 0 end)%3 when")
PROFILE_INDEX_BEFORE = View("orders", PROFILE_INDEX.columns, "o_orderkey%7<>0")
PROFILE_INDEX_AFTER = View(
    "orders",
    {
        **PROFILE_INDEX.columns,
        "file": _NEXT_FILE,
        "date_update": f"case when o_custkey%50=0 then '20070615060000' else {PROFILE_INDEX.columns['date_update']} end",
    },
    "o_custkey%41<>0",
)

# A coarse atlas of salinity ratios that goes round the globe and to both poles, with holes.
ATLAS_STEP, ATLAS_AROUND = 30, 12
ATLAS_POINTS = View(
    "part",
    {
        "east": "cast(p_partkey%12 as int)",
        "north": "cast(floor(p_partkey/12e0) as int)%7",
        "level": "cast(floor(p_partkey/84e0) as int)%4",
        "ratio": "cast((p_partkey*29)%64 as double)/65536e0",
    },
)
ATLAS_SQL = (
    "SELECT 1e0+30e0*east AS longitude, -90e0+30e0*north AS latitude, 500e0*level AS pressure, min(ratio) AS ratio "
    "FROM atlas_points WHERE (east+3*north+level)%7<>5 GROUP BY east, north, level"
)

ARRIVALS = View("events", {"arrived": "ts", "failed": "event_id%9=0"})

MANIFEST = View("supplier", {"input_file": "concat('p', cast(s_suppkey as string))"})
# Files of some suppliers are under names that the manifest does not have.
LOADED = View("lineitem", {"input_file": "concat(case when l_suppkey%7=0 then 'q' else 'p' end, cast(l_suppkey as string))"})

VIEWS = {
    "obs_phy": OBS_PHY,
    "obs_bgc": OBS_BGC,
    "src_bottle": SRC_BOTTLE,
    "src_plankton": SRC_PLANKTON,
    "plankton_lines": PLANKTON_LINES,
    "src_glider": SRC_GLIDER,
    "profile_index": PROFILE_INDEX,
    "local_inventory": LOCAL_INVENTORY,
    "messy": MESSY,
    "reissued": REISSUED,
    "arrivals": ARRIVALS,
    "arrivals_in_batches": ARRIVALS_IN_BATCHES,
    "profile_index_before": PROFILE_INDEX_BEFORE,
    "profile_index_after": PROFILE_INDEX_AFTER,
    "atlas_points": ATLAS_POINTS,
    "manifest": MANIFEST,
    "loaded": LOADED,
}
