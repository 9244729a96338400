"""Seawater properties as native column expressions.

Published standards: TEOS-10 (75-term specific volume, Gibbs function pieces), PSS-78, Garcia & Gordon 1992.
Every function takes SQL fragments (a column name, a number) and returns a SQL expression for ``F.expr`` or
``selectExpr``: one parsed string per formula instead of a thousand calls per plan, and the whole chain stays inside
generated code. Fragments that are used repeatedly should be columns, see ``with_properties``.
"""

from functools import reduce

from pyspark.sql import functions as F

# Fixed values of TEOS-10 and of the unit conversions.
REFERENCE_SALINITY = 35.16504
HEAT_CAPACITY = 3991.86795711963
SALINITY_SCALE = 0.0248826675584615
SALINITY_SHIFT = 0.5971840214030754
GRAVITY = 9.7963
ML_PER_UMOL = 0.022391
MG_PER_ML = 1.42905

# Specific volume, coefficient of xs^i ys^j zs^k under key "ijk".
VOLUME_TERMS = {
    "000": 1.0769995862e-3, "001": -6.0799143809e-5, "002": 9.9856169219e-6, "003": -1.1309361437e-6,
    "004": 1.0531153080e-7, "005": -1.2647261286e-8, "006": 1.9613503930e-9, "010": -1.5649734675e-5,
    "011": 1.8505765429e-5, "012": -1.1736386731e-6, "013": -3.6527006553e-7, "014": 3.1454099902e-7,
    "020": 2.7762106484e-5, "021": -1.1716606853e-5, "022": 2.1305028740e-6, "023": 2.8695905159e-7,
    "030": -1.6521159259e-5, "031": 7.9279656173e-6, "032": -4.6132540037e-7, "040": 6.9111322702e-6,
    "041": -3.4102187482e-6, "042": -6.3352916514e-8, "050": -8.0539615540e-7, "051": 5.0736766814e-7,
    "060": 2.0543094268e-7,
    "100": -3.1038981976e-4, "101": 2.4262468747e-5, "102": -5.8484432984e-7, "103": 3.6310188515e-7,
    "104": -1.1147125423e-7, "110": 3.5009599764e-5, "111": -9.5677088156e-6, "112": -5.5699154557e-6,
    "113": -2.7295696237e-7, "120": -3.7435842344e-5, "121": -2.3678308361e-7, "122": 3.9137387080e-7,
    "130": 2.4141479483e-5, "131": -3.4558773655e-6, "132": 7.7618888092e-9, "140": -8.7595873154e-6,
    "141": 1.2956717783e-6, "150": -3.3052758900e-7,
    "200": 6.6928067038e-4, "201": -3.4792460974e-5, "202": -4.8122251597e-6, "203": 1.6746303780e-8,
    "210": -4.3592678561e-5, "211": 1.1100834765e-5, "212": 5.4620748834e-6, "220": 3.5907822760e-5,
    "221": 2.9283346295e-6, "222": -6.5731104067e-7, "230": -1.4353633048e-5, "231": 3.1655306078e-7,
    "240": 4.3703680598e-6,
    "300": -8.5047933937e-4, "301": 3.7470777305e-5, "302": 4.9263106998e-6, "310": 3.4532461828e-5,
    "311": -9.8447117844e-6, "312": -1.3544185627e-6, "320": -1.8698584187e-5, "321": -4.8826139200e-7,
    "330": 2.2863324556e-6,
    "400": 5.8086069943e-4, "401": -1.7322218612e-5, "402": -1.7811974727e-6, "410": -1.1959409788e-5,
    "411": 2.5909225260e-6, "420": 3.8595339244e-6,
    "500": -2.1092370507e-4, "501": 3.0927427253e-6, "510": 1.3864594581e-6,
    "600": 3.1932457305e-5,
}

# Entropy part of the Gibbs function, one row per power of y, one entry per power of z.
ENTROPY_PURE = [
    [0.0, -270.983805184062, 776.153611613101, -196.51255088122, 28.9796526294175, -2.13290083518327],
    [-24715.571866078, 2910.0729080936, -1513.116771538718, 546.959324647056, -111.1208127634436, 8.68841343834394],
    [2210.2236124548363, -2017.52334943521, 1498.081172457456, -718.6359919632359, 146.4037555781616,
     -4.9892131862671505],
    [-592.743745734632, 1591.873781627888, -1207.261522487504, 608.785486935364, -105.4993508931208],
    [290.12956292128547, -973.091553087975, 602.603274510125, -276.361526170076, 32.40953340386105],
    [-113.90630790850321, 381.06836198507096, -133.7383902842754, 49.023632509086724],
    [21.35571525415769, -67.41756835751434],
]
# The saline part, in the same layout, for the factors x^2, x^3 and x^4.
ENTROPY_SALINE = [
    [
        [0.0, 729.116529735046, -343.956902961561, 124.687671116248, -31.656964386073, 7.04658803315449],
        [1760.062705994408, -1721.528607567954, 674.819060538734, -356.629112415276, 88.4080716616, -15.84003094423364],
        [-675.802947790203, 2082.7344423998043, -614.668925894709, 340.685093521782, -33.3848202979239],
        [365.7041791005036, -1190.914967948748, 298.904564555024, -145.9491676006352],
        [-108.30162043765552],
        [12.78101825083098],
    ],
    [
        [0.0, -175.292041186547, 83.1923927801819, -29.483064349429],
        [-86.1329351956084, 766.116132004952, -108.3834525034224, 51.2796974779828],
        [-30.0682112585625, -1380.9597954037708],
        [3.50240264723578, 938.26075044542],
    ],
    [
        [0.0, -22.6683558512829],
        [-137.1145018408982],
        [148.10030845687618],
        [-68.5590309679152],
        [12.4848504784754],
    ],
]
# Second temperature derivative at the surface, powers of y, pure part and factors x^2, x^3, x^4.
CURVATURE_PURE = [-24715.571866078, 4420.4472249096725, -1778.231237203896, 1160.5182516851419, -569.531539542516,
                  128.13429152494615]
CURVATURE_SALINE = [
    [1760.062705994408, -1351.605895580406, 1097.1125373015109, -433.20648175062206, 63.905091254154904],
    [-86.1329351956084, -60.136422517125, 10.50720794170734],
    [-137.1145018408982, 296.20061691375236, -205.67709290374563, 49.9394019139016],
]
# Potential enthalpy, powers of y, pure part and factors x^2 to x^7.
ENTHALPY_PURE = [61.01362420681071, 168776.46138048015, -2735.2785605119625, 2574.2164453821433, -1536.6644434977543,
                 545.7340497931629, -50.91091728474331, -18.30489878927802]
ENTHALPY_SALINE = [
    [268.5520265845071, -12019.028203559312, 3734.858026725145, -2046.7671145057618, 465.28655623826234,
     -0.6370820302376359, -10.650848542359153],
    [937.2099110620707, 588.1802812170108, 248.39476522971285, -3.871557904936333, -2.6268019854268356],
    [-1687.914374187449, 936.3206544460336, -942.7827304544439, 369.4389437509002, -33.83664947895248,
     -9.987880382780322],
    [246.9598888781377],
    [123.59576582457964],
    [-48.5891069025409],
]


def number(value):
    """A DOUBLE literal; fragments pass through."""
    return f"{value!r}D" if isinstance(value, float) else str(value)


def poly(coefficients, v):
    """Horner form; coefficients from the constant upwards, numbers or fragments. ``v`` is a short fragment."""
    return reduce(lambda acc, c: f"({acc} * {v} + {number(c)})", reversed(coefficients[:-1]), number(coefficients[-1]))


def _poly2(rows, y, z):
    """Rows by power of y, entries by power of z; without ``z`` the value at z = 0."""
    return poly([row[0] if z is None else poly(row, z) for row in rows], y)


def _saline(parts, x2, x):
    """x^2 times the polynomial in x whose coefficients are ``parts``."""
    return f"{x2} * {poly(parts, x)}"


def absolute_salinity(practical, saar=None):
    """Absolute salinity; ``saar`` is the geographic anomaly ratio, 0 where there is none."""
    scaled = f"{practical} * {number(REFERENCE_SALINITY / 35.0)}"
    return scaled if saar is None else f"{scaled} * (1D + coalesce({saar}, 0D))"


def depth_from_pressure(pressure, latitude):
    """Depth in m, positive down. ``latitude`` is a number or a fragment in degrees."""
    sin2 = f"pow(sin(radians({number(latitude)})), 2)"
    b = f"({poly([1.0, 5.2792e-3, 2.32e-5], sin2)} * 9.780327D)"
    # Specific volume anomaly of the standard ocean, integrated.
    w = f"({pressure} * 1e-4D)"
    c = "(1e8D * " + w + " * " + poly([
        9.726613854843870e-4, -2.252956605630465e-5, 2.376909655387404e-6, -1.664294869986011e-7,
        -5.988108894465758e-9, -2.1078768810e-9, 2.8019291329e-10], w) + ")"
    return f"2D * {c} / ({b} + sqrt({b} * {b} + 4D * 0.5D * 2.26e-7D * {b} * {c}))"


def entropy_part(x2, x, y, z=None):
    saline = _saline([_poly2(p, y, z) for p in ENTROPY_SALINE], x2, x)
    return f"-0.025D * ({_poly2(ENTROPY_PURE, y, z)} + {saline})"


def curvature(x2, x, y):
    saline = _saline([poly(p, y) for p in CURVATURE_SALINE], x2, x)
    return f"0.000625D * ({poly(CURVATURE_PURE, y)} + {saline})"


def conservative_temperature(x2, x, y):
    """``y`` is 0.025 times potential temperature."""
    saline = _saline([poly(p, y) for p in ENTHALPY_SALINE], x2, x)
    return f"({poly(ENTHALPY_PURE, y)} + {saline}) / {number(HEAT_CAPACITY)}"


def potential_start(sa, t, p):
    """First guess of potential temperature (surface reference)."""
    s1 = f"{sa} * {number(35.0 / REFERENCE_SALINITY)}"
    inner = (f"(-8.38241357039698e-6D + {s1} * 2.83933368585534e-8D + {t} * 1.77803965218656e-8D"
             f" + {p} * 1.71155619208233e-10D)")
    return (f"{t} + {p} * (8.65483913395442e-6D - {s1} * 1.41636299744881e-6D - {p} * 7.38286467135737e-9D"
            f" + {t} * {inner})")


def volume(xs, ys, zs, by=""):
    """Specific volume, or its derivative with respect to ``by`` ("x" or "y")."""
    axis = {"": None, "x": 0, "y": 1}[by]
    terms = {}
    for key, c in VOLUME_TERMS.items():
        power = [int(d) for d in key]
        if axis is not None:
            c, power[axis] = c * power[axis], power[axis] - 1
            if power[axis] < 0:
                continue
        terms[tuple(power)] = c

    def level(prefix, rest):
        if not rest:
            return terms[prefix]
        top = max(k[len(prefix)] for k in terms if k[:len(prefix)] == prefix)
        return poly([level(prefix + (i,), rest[1:]) for i in range(top + 1)], rest[0])

    return level((), [xs, ys, zs])


def salinity_root(sa):
    return f"sqrt({sa} * {number(SALINITY_SCALE)} + {number(SALINITY_SHIFT)})"


def density(sa, ct, p):
    return f"1D / {volume(salinity_root(sa), f'({ct} * 0.025D)', f'({p} * 1e-4D)')}"


def oxygen_log(potential):
    """The scaled temperature of ``oxygen_solubility``."""
    return f"ln((298.15D - 1.00024D * {potential}) / (273.15D + 1.00024D * {potential}))"


def oxygen_solubility(practical, y):
    """umol/kg from practical salinity and the scaled potential temperature ``oxygen_log``."""
    # Garcia & Gordon 1992, Benson & Krause refit.
    free = poly([5.80871, 3.20291, 4.17887, 5.10006, -9.86643e-2, 3.80369], y)
    saline = poly([-7.01577e-3, -7.70028e-3, -1.13864e-2, -9.51519e-3], y)
    return f"exp({free} + {practical} * ({saline} - 2.75915e-7D * {practical}))"


def oxygen_mgkg(t, s, saturation):
    inverse = f"(1D / ({t} + 273.15D))"
    # Benson & Krause 1984, per mass.
    free = poly([-138.74202, 1.572288e5, -6.637149e7, 1.243678e10, -8.621061e11], inverse)
    return f"{saturation} * exp({free} - {s} * {poly([0.020573, -12.142, 2363.1], inverse)}) / 100D"


def oxygen_mgl(t, s, saturation):
    h = f"(({t} + 273.15D) / 100D)"
    # Weiss 1970, ml to mg.
    free = f"-173.4292D + 249.6339D / {h} + 143.3483D * ln({h}) - 21.8492D * {h}"
    return f"{saturation} * 1.428D * exp({free} + {s} * {poly([-0.033096, 0.014259, -0.0017], h)}) / 100D"


def salinity_15c(conductivity):
    """Practical salinity at 15 degrees from conductivity in S/m."""
    # PSS-78 at 15 degrees.
    return poly([0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081], f"sqrt({conductivity} / 4.2914D)")


def ratio_root(ratio, t90, p):
    """Square root of the conductivity ratio reduced to the surface, for ``practical_salinity``."""
    t = f"(1.00024D * {t90})"
    # PSS-78.
    rt = poly([0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9], t)
    rp = (f"(1D + {p} * {poly([2.070e-5, -6.370e-10, 3.989e-15], p)}"
          f" / (1D + {t} * {poly([3.426e-2, 4.464e-4], t)} + {ratio} * {poly([4.215e-1, -3.107e-3], t)}))")
    return f"sqrt({ratio} / ({rp} * {rt}))"


def practical_salinity(root, t90):
    """PSS-78 from ``ratio_root``."""
    d = f"(1.00024D * {t90} - 15D)"
    # PSS-78.
    return (poly([0.008, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081], root) + f" + {d} / (1D + 0.0162D * {d}) * "
            + poly([0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144], root))


def solid(expression):
    """NaN instead of NULL."""
    return f"coalesce({expression}, double('NaN'))"


def hollow(expression):
    """NULL instead of NaN."""
    return f"CASE WHEN NOT isnan({expression}) THEN {expression} END"


def with_columns(df, **expressions):
    """Columns from SQL expressions, in one select."""
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def with_properties(df, pressure="pressure_dbar", temperature="temperature_C", practical="salinity_psu", saar=None):
    """Add ``_SA``, ``_CT``, ``pot_temp_C`` and ``density_kg_m3``.

    Potential temperature is two Newton steps with the slope renewed halfway. Each select uses the columns of the ones
    before, so no value is computed twice.
    """
    def miss(guess):
        return entropy_part("_x2", "_x", f"({guess} * 0.025D)") + " - _here"

    def bend(new, old):
        return "-" + curvature("_x2", "_x", f"(({new} + {old}) * 0.0125D)")

    # Missing inputs run as NaN and become NULL again at the end: expressions that cannot be NULL need no null checks,
    # which keeps the generated code a third of the size. A division may be NULL to Spark, so it is wrapped as well.
    df = with_columns(df, _p=solid(f"abs({pressure})"), _SA=solid(absolute_salinity(practical, saar)),
                      _ti=solid(temperature))
    df = with_columns(df, _x2=f"_SA * {number(SALINITY_SCALE)}", _x=f"sqrt(_SA * {number(SALINITY_SCALE)})",
                      _g0=potential_start("_SA", "_ti", "_p"))
    df = with_columns(df, _here=entropy_part("_x2", "_x", "(_ti * 0.025D)", "(_p * 1e-4D)"))
    df = with_columns(df, _miss0=miss("_g0"), _slope0=(
        f"((273.15D + _g0) * (1D - 0.05D * (1D - _SA * {number(1.0 / REFERENCE_SALINITY)})))"
        f" * {number(1.0 / HEAT_CAPACITY)}"))
    df = with_columns(df, _slope1=bend("(_g0 - _miss0 * _slope0)", "_g0"))
    df = with_columns(df, _g1=solid("_g0 - _miss0 / _slope1"))
    df = with_columns(df, _miss1=miss("_g1"))
    df = with_columns(df, _half=solid("_g1 - _miss1 / _slope1"))
    df = with_columns(df, _g2=solid(f"_g1 - _miss1 / ({bend('_half', '_g1')})"))
    df = with_columns(df, _cons=solid(conservative_temperature("_x2", "_x", "(_g2 * 0.025D)")), _xs=salinity_root("_SA"))
    df = with_columns(df, _rho=f"1D / {volume('_xs', '(_cons * 0.025D)', '(_p * 1e-4D)')}")
    results = {"_SA": "_SA", "pot_temp_C": "_g2", "_CT": "_cons", "density_kg_m3": "_rho"}
    df = with_columns(df, **{name: hollow(c) for name, c in results.items()})
    return df.drop("_p", "_ti", "_x2", "_x", "_g0", "_here", "_miss0", "_slope0", "_slope1", "_g1", "_miss1", "_half",
                   "_g2", "_cons", "_xs", "_rho")


def with_buoyancy(pairs, sa="_SA", ct="_CT", p="_p", after="next_"):
    """Add ``N2`` to rows that carry salinity, temperature and pressure of two levels; not finite -> NULL."""
    def mean(c):
        return f"({c} + {after}{c}) * 0.5D"

    pairs = with_columns(
        pairs, _xs=solid(salinity_root(f"({mean(sa)})")), _ys=solid(f"{mean(ct)} * 0.025D"),
        _zs=solid(f"{mean(p)} * 1e-4D"), _ds=solid(f"{after}{sa} - {sa}"), _dt=solid(f"{after}{ct} - {ct}"),
        _dp=solid(f"{after}{p} - {p}"))
    pairs = with_columns(pairs, _v=volume("_xs", "_ys", "_zs"), _vx=volume("_xs", "_ys", "_zs", "x"),
                         _vy=volume("_xs", "_ys", "_zs", "y"))
    # Both coefficients carry 1/v and the density another: one division for all.
    pairs = with_columns(pairs, N2=(
        f"try_divide({number(-GRAVITY * GRAVITY)} * ({number(0.5 * SALINITY_SCALE)} * _vx * _ds / _xs"
        " + 0.025D * _vy * _dt), _v * _v * 1e4D * _dp)"))
    finite = ~F.isnan("N2") & (F.abs("N2") < float("inf"))
    return pairs.withColumn("N2", F.when(finite, F.col("N2"))).drop(
        "_xs", "_ys", "_zs", "_ds", "_dt", "_dp", "_v", "_vx", "_vy")
