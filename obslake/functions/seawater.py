"""Seawater properties after the TEOS-10 manual (IOC, SCOR and IAPSO, 2010), as Columns.

Each property is a polynomial with fixed coefficients. They are written here once as
tables and turned into Horner form. Inputs are made non-null doubles (NaN for null), so
that the generated code has no null checks between the many small steps; results that are
NaN become null again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: constants --------------------------------------------------------

SSO = 35.16504  # reference salinity of standard seawater, g/kg
SALINITY_SCALE = 0.0248826675584615
SALINITY_OFFSET = 0.5971840214030754
HEAT_CAPACITY = 3991.86795711963
ZERO_CELSIUS = 273.15
SIGMA1_PRESSURE = 1000.0  # dbar

# --- fixed values: specific volume, rows of z^k coefficients for each (power of x, power of y) (Roquet et al., 2015) --

SPECIFIC_VOLUME_ROWS = {
    (0, 0): (1.0769995862e-3, -6.0799143809e-5, 9.9856169219e-6, -1.1309361437e-6, 1.0531153080e-7, -1.2647261286e-8, 1.9613503930e-9),
    (0, 1): (-1.5649734675e-5, 1.8505765429e-5, -1.1736386731e-6, -3.6527006553e-7, 3.1454099902e-7),
    (0, 2): (2.7762106484e-5, -1.1716606853e-5, 2.1305028740e-6, 2.8695905159e-7),
    (0, 3): (-1.6521159259e-5, 7.9279656173e-6, -4.6132540037e-7),
    (0, 4): (6.9111322702e-6, -3.4102187482e-6, -6.3352916514e-8),
    (0, 5): (-8.0539615540e-7, 5.0736766814e-7),
    (0, 6): (2.0543094268e-7,),
    (1, 0): (-3.1038981976e-4, 2.4262468747e-5, -5.8484432984e-7, 3.6310188515e-7, -1.1147125423e-7),
    (1, 1): (3.5009599764e-5, -9.5677088156e-6, -5.5699154557e-6, -2.7295696237e-7),
    (1, 2): (-3.7435842344e-5, -2.3678308361e-7, 3.9137387080e-7),
    (1, 3): (2.4141479483e-5, -3.4558773655e-6, 7.7618888092e-9),
    (1, 4): (-8.7595873154e-6, 1.2956717783e-6),
    (1, 5): (-3.3052758900e-7,),
    (2, 0): (6.6928067038e-4, -3.4792460974e-5, -4.8122251597e-6, 1.6746303780e-8),
    (2, 1): (-4.3592678561e-5, 1.1100834765e-5, 5.4620748834e-6),
    (2, 2): (3.5907822760e-5, 2.9283346295e-6, -6.5731104067e-7),
    (2, 3): (-1.4353633048e-5, 3.1655306078e-7),
    (2, 4): (4.3703680598e-6,),
    (3, 0): (-8.5047933937e-4, 3.7470777305e-5, 4.9263106998e-6),
    (3, 1): (3.4532461828e-5, -9.8447117844e-6, -1.3544185627e-6),
    (3, 2): (-1.8698584187e-5, -4.8826139200e-7),
    (3, 3): (2.2863324556e-6,),
    (4, 0): (5.8086069943e-4, -1.7322218612e-5, -1.7811974727e-6),
    (4, 1): (-1.1959409788e-5, 2.5909225260e-6),
    (4, 2): (3.8595339244e-6,),
    (5, 0): (-2.1092370507e-4, 3.0927427253e-6),
    (5, 1): (1.3864594581e-6,),
    (6, 0): (3.1932457305e-5,),
}

# --- fixed values: negative entropy, rows of z^k coefficients for each (power of x, power of y) --

ENTROPY_ROWS = {
    (0, 0): (0.0, -270.983805184062, 776.153611613101, -196.51255088122, 28.9796526294175, -2.13290083518327),
    (0, 1): (-24715.571866078, 2910.0729080936, -1513.116771538718, 546.959324647056, -111.1208127634436, 8.68841343834394),
    (0, 2): (2210.2236124548363, -2017.52334943521, 1498.081172457456, -718.6359919632359, 146.4037555781616, -4.9892131862671505),
    (0, 3): (-592.743745734632, 1591.873781627888, -1207.261522487504, 608.785486935364, -105.4993508931208),
    (0, 4): (290.12956292128547, -973.091553087975, 602.603274510125, -276.361526170076, 32.40953340386105),
    (0, 5): (-113.90630790850321, 381.06836198507096, -133.7383902842754, 49.023632509086724),
    (0, 6): (21.35571525415769, -67.41756835751434),
    (2, 0): (0.0, 729.116529735046, -343.956902961561, 124.687671116248, -31.656964386073, 7.04658803315449),
    (2, 1): (1760.062705994408, -1721.528607567954, 674.819060538734, -356.629112415276, 88.4080716616, -15.84003094423364),
    (2, 2): (-675.802947790203, 2082.7344423998043, -614.668925894709, 340.685093521782, -33.3848202979239),
    (2, 3): (365.7041791005036, -1190.914967948748, 298.904564555024, -145.9491676006352),
    (2, 4): (-108.30162043765552,),
    (2, 5): (12.78101825083098,),
    (3, 0): (0.0, -175.292041186547, 83.1923927801819, -29.483064349429),
    (3, 1): (-86.1329351956084, 766.116132004952, -108.3834525034224, 51.2796974779828),
    (3, 2): (-30.0682112585625, -1380.9597954037708),
    (3, 3): (3.50240264723578, 938.26075044542),
    (4, 0): (0.0, -22.6683558512829),
    (4, 1): (-137.1145018408982,),
    (4, 2): (148.10030845687618,),
    (4, 3): (-68.5590309679152,),
    (4, 4): (12.4848504784754,),
}

# --- fixed values: enthalpy at the surface, rows of y^j coefficients for each power of x --

ENTHALPY_ROWS = {
    0: (61.01362420681071, 168776.46138048015, -2735.2785605119625, 2574.2164453821433, -1536.6644434977543,
        545.7340497931629, -50.91091728474331, -18.30489878927802),
    2: (268.5520265845071, -12019.028203559312, 3734.858026725145, -2046.7671145057618, 465.28655623826234,
        -0.6370820302376359, -10.650848542359153),
    3: (937.2099110620707, 588.1802812170108, 248.39476522971285, -3.871557904936333, -2.6268019854268356),
    4: (-1687.914374187449, 936.3206544460336, -942.7827304544439, 369.4389437509002, -33.83664947895248,
        -9.987880382780322),
    5: (246.9598888781377,),
    6: (123.59576582457964,),
    7: (-48.5891069025409,),
}

# --- fixed values: first guess of potential temperature and of entropy's slope, gravity and pressure from height --

GUESS_WARMING = (-8.38241357039698e-6, 1.77803965218656e-8)  # powers of t
GUESS_WARMING_SALINITY, GUESS_WARMING_PRESSURE = 2.83933368585534e-8, 1.71155619208233e-10
GUESS_HALINE = (8.65483913395442e-6, -1.41636299744881e-6)  # powers of scaled salinity
GUESS_PRESSURE = 7.38286467135737e-9
SLOPE_DILUTION = (0.95, 0.05)
GRAVITY_EQUATOR = 9.780327
GRAVITY_SINE_SQUARED = (1.0, 5.2792e-3, 2.32e-5)
GRAVITY_HEIGHT = 2.26e-7
PRESSURE_SINE_SQUARED = (1 - 5.92e-3, -5.25e-3)
PRESSURE_HEIGHT = 8.84e-6

# --- end of fixed values ------------------------------------------------------------


Term = float | str


def specific_volume_terms() -> dict[tuple[int, int, int], float]:
    return {(i, j, k): value for (i, j), row in SPECIFIC_VOLUME_ROWS.items() for k, value in enumerate(row)}


def dense(terms: Mapping[int, Term]) -> list[Term]:
    """Coefficients by power, lowest first, with zeros for the powers left out."""
    return [terms.get(power, 0.0) for power in range(max(terms) + 1)]


def _text(term: Term) -> str:
    return f"({term!r}D)" if isinstance(term, float) else f"({term})"


def horner(coefficients: Sequence[Term], at: str) -> str:
    """The polynomial with these coefficients, lowest power first, as an expression."""
    *lower, top = coefficients
    total = _text(top)
    for term in reversed(lower):
        total = f"({total} * {at})" if term == 0.0 else f"({total} * {at} + {_text(term)})"
    return total


def surface_entropy_rows() -> dict[int, dict[int, float]]:
    """Entropy at zero pressure: for each power of y, the coefficients by power of x."""
    rows: dict[int, dict[int, float]] = {}
    for (i, j), by_z in ENTROPY_ROWS.items():
        if by_z[0] != 0.0:
            rows.setdefault(j, {})[i] = by_z[0]
    return rows


def sigma1_rows() -> list[list[float]]:
    """Specific volume at 1000 dbar: for each power of y, the coefficients of the powers of x."""
    z = 1e-4 * SIGMA1_PRESSURE
    rows: dict[int, dict[int, float]] = {}
    for (i, j, k), value in specific_volume_terms().items():
        row = rows.setdefault(j, {})
        row[i] = row.get(i, 0.0) + value * z**k
    return [dense(rows[j]) for j in sorted(rows)]


def standard_volume_row() -> list[float]:
    """Specific volume of standard seawater at 0 degrees: coefficients of the powers of 1e-4 p."""
    x = (SALINITY_SCALE * SSO + SALINITY_OFFSET) ** 0.5
    by_z: dict[int, float] = {}
    for (i, j, k), value in specific_volume_terms().items():
        if j == 0:
            by_z[k] = by_z.get(k, 0.0) + value * x**i
    return dense(by_z)


def _number(column: str) -> str:
    return f"coalesce(cast(`{column}` as double), double('NaN'))"


def _ratio(numerator: str, denominator: str) -> str:
    return f"coalesce(try_divide({numerator}, {denominator}), double('NaN'))"


class _Stages:
    """Adds intermediate results to a table, one projection at a time, and takes them out at the end.

    Nested into one expression, every use of an intermediate result would repeat all of
    its arithmetic. The expressions are SQL text, since a Column would need a call into
    the JVM for each of some hundred steps.
    """

    def __init__(self, df: DataFrame, **inputs: str):
        self.columns = [f"`{c}`" for c in df.columns]
        self.names = list(inputs)
        self.df = df.selectExpr(*self.columns, *[f"{_number(c)} as __{n}" for n, c in inputs.items()])

    def add(self, **new: str) -> None:
        kept = [f"__{n}" for n in self.names if n not in new]
        self.df = self.df.selectExpr(*self.columns, *kept, *[f"{e} as __{n}" for n, e in new.items()])
        self.names = [*dict.fromkeys([*self.names, *new])]

    def finish(self, name: str, result: str) -> DataFrame:
        """The table with the result as a float column, NaN turned into null.

        The one-element ``explode`` keeps a later filter on the result above it. Pushed
        down, the filter would have all stages nested into it.
        """
        self.add(result=result)
        others = [c for c in self.columns if c != f"`{name}`"]
        value = "case when not isnan(__result) then cast(__result as float) end"
        return self.df.selectExpr(*others, f"explode(array({value})) as `{name}`")


def absolute_salinity(psal: Column, anomaly: Column | None = None) -> Column:
    """Absolute salinity in g/kg. Without the regional anomaly ratio it is the reference salinity."""
    reference = psal.cast("double") * F.lit(SSO / 35)
    total = reference if anomaly is None else reference * (F.lit(1.0) + F.coalesce(anomaly, F.lit(0.0)))
    return total.cast("float")


def with_conservative_temperature(df: DataFrame, name: str, sa: str, temperature: str, pressure: str) -> DataFrame:
    """Add conservative temperature from absolute salinity, in-situ temperature and pressure.

    Potential temperature at the surface is where the entropy equals that of the sample.
    It is found by two rounds of a Newton step that takes the slope half-way.
    """
    s = _Stages(df, sa=sa, t=temperature, p=pressure)
    s.add(
        x=f"sqrt(__sa * {SALINITY_SCALE}D)",
        y="__t * 0.025D",
        z="__p * 1e-4D",
        u=f"__sa * {35 / SSO}D",
    )

    # The sample's entropy, by power of x, and the first guess of the temperature.
    by_x: dict[int, dict[int, str]] = {}
    for (i, j), by_z in ENTROPY_ROWS.items():
        by_x.setdefault(i, {})[j] = horner(by_z, "__z")
    warming = horner(GUESS_WARMING, "__t")
    warming = f"({warming} + __u * {GUESS_WARMING_SALINITY}D + __p * {GUESS_WARMING_PRESSURE}D)"
    haline = horner(GUESS_HALINE, "__u")
    guess = f"__t + __p * ({haline} - __p * {GUESS_PRESSURE}D + __t * {warming})"
    s.add(q=guess, **{f"e{i}": horner(dense(row), "__y") for i, row in by_x.items()})

    surface = surface_entropy_rows()
    dilution = horner([SLOPE_DILUTION[0], SLOPE_DILUTION[1] / SSO], "__sa")
    s.add(
        y="__q * 0.025D",
        target=horner(dense({i: f"__e{i}" for i in by_x}), "__x"),
        slope=_ratio(f"{-HEAT_CAPACITY / 0.025**2}D", f"(__q + {ZERO_CELSIUS}D) * {dilution}"),
        **{f"a{j}": horner(dense(row), "__x") for j, row in surface.items()},
    )
    entropy = dense({j: f"__a{j}" for j in surface})
    entropy_slope = [f"__a{j} * {float(j)}D" for j in range(1, max(surface) + 1)]
    for _ in range(2):
        s.add(gap=f"{horner(entropy, '__y')} - __target")
        s.add(middle=f"__y - {_ratio('__gap', '__slope')} * 0.5D")
        s.add(slope=horner(entropy_slope, "__middle"))
        s.add(y=f"__y - {_ratio('__gap', '__slope')}")

    enthalpy = {i: horner(row, "__y") for i, row in ENTHALPY_ROWS.items()}
    return s.finish(name, f"{horner(dense(enthalpy), '__x')} * {1 / HEAT_CAPACITY}D")


def with_sigma1(df: DataFrame, name: str, sa: str, ct: str) -> DataFrame:
    """Add the potential density anomaly at 1000 dbar from absolute salinity and conservative temperature."""
    rows = sigma1_rows()
    s = _Stages(df, sa=sa, ct=ct)
    s.add(x=f"sqrt({horner([SALINITY_OFFSET, SALINITY_SCALE], '__sa')})", y="__ct * 0.025D")
    s.add(**{f"v{j}": horner(row, "__x") for j, row in enumerate(rows)})
    s.add(v=horner([f"__v{j}" for j in range(len(rows))], "__y"))
    return s.finish(name, f"{_ratio('1.0D', '__v')} - 1000.0D")


def with_pressure(df: DataFrame, name: str, depth: str, latitude: str) -> DataFrame:
    """Add pressure in dbar from depth in metres (positive down) and latitude.

    A closed first guess, then one Newton step that takes the slope half-way.
    """
    volume = standard_volume_row()
    height = [0.0] + [1e8 * v / (j + 1) for j, v in enumerate(volume)]
    slope = [1e4 * v for v in volume]
    s = _Stages(df, depth=depth, latitude=latitude)
    s.add(h="-__depth", sine="sin(radians(__latitude))")
    s.add(ss="__sine * __sine")
    s.add(
        gravity=f"{horner(GRAVITY_SINE_SQUARED, '__ss')} * {GRAVITY_EQUATOR}D",
        c=horner(PRESSURE_SINE_SQUARED, "__ss"),
    )
    s.add(p=_ratio("__h * -2.0D", f"__c + sqrt(__c * __c + __h * {PRESSURE_HEIGHT}D)"))
    potential = f"__h * __gravity * {horner([1.0, -0.5 * GRAVITY_HEIGHT], '__h')}"
    s.add(gap=f"{horner(height, '(__p * 1e-4D)')} + {potential}")
    s.add(middle=f"__p - {_ratio('__gap', horner(slope, '(__p * 1e-4D)'))} * 0.5D")
    return s.finish(name, f"__p - {_ratio('__gap', horner(slope, '(__middle * 1e-4D)'))}")
