"""Plain SQL for every query, over the driver's tables, in the dialect of an embedded SQL engine.

expression per formula. It is slow and simple on purpose.
"""

import re

from fathomline.functions.seawater import VOLUME_TERMS

SCANS = """
r AS (
  SELECT l_suppkey AS cast_no, l_quantity AS q, l_discount + 0.0 AS d, l_tax + 0.0 AS x, l_extendedprice AS e,
         CAST(row_number() OVER (PARTITION BY l_suppkey
              ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate) - 1 AS BIGINT) AS scan
  FROM lineitem
), s0 AS (
  SELECT *, CASE WHEN scan < 24 THEN 0.0 ELSE 60.0 - abs(((scan - 24) % 240) - 120) * 0.5 END AS base,
         (scan < 24 AND cast_no % 7 <> 3) OR cast_no % 31 = 30 AS in_air,
         TIMESTAMP '2024-07-03 08:00:00' + to_days(CAST((cast_no // 10) % 3650 AS INTEGER))
           + to_seconds(CAST(scan + (cast_no % 10) * 60 AS BIGINT)) AS clock
  FROM r
), scans AS (
  SELECT cast_no, 'cast_' || cast_no AS cast_id, scan,
    CASE cast_no % 5 WHEN 0 THEN 'idronaut' WHEN 1 THEN 'seabird' WHEN 2 THEN 'rbr'
                     WHEN 3 THEN 'exo' ELSE 'gf23' END AS ctd_type,
    'cast_' || cast_no || '.txt' AS source_file,
    CASE WHEN cast_no % 5 = 2 THEN clock END AS timestamp, CASE WHEN cast_no % 5 <> 2 THEN clock END AS datetime,
    round(CASE WHEN in_air THEN 0.25 + x ELSE base + 0.5 + d END, 4) AS pressure_dbar,
    round(18.0 - 0.2 * base + d, 4) AS temperature_C,
    CAST(CASE WHEN in_air THEN round(0.01 + d * 0.5, 4) WHEN scan = 24 THEN 0.15
              ELSE round(2500.0 + 10.0 * base + 100.0 * x, 4) END AS DOUBLE) AS conductivity_mS_per_m,
    round(20.0 + 0.2 * base + x, 4) AS salinity_psu,
    round(CASE WHEN in_air AND cast_no % 11 = 5 THEN 180.0 WHEN in_air THEN 101.5 + 10.0 * x
               ELSE 96.0 - 0.5 * base + d END, 4) AS oxygen_saturation_percent,
    CAST(CASE WHEN q = 50 THEN NULL ELSE round(5.5 + 0.08 * q, 4) END AS DOUBLE) AS ph,
    round(e / 100.0, 4) AS PAR_umol_m2_s
  FROM s0
)"""

LOGBOOK = """
logbook AS (
  SELECT s_suppkey AS entry_no, 'ST' || (s_suppkey % 26) AS Station, CAST(s_suppkey % 40 + 1 AS DOUBLE) AS station_ODV,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'campaign_' || s_nationkey END AS campaign,
    CASE s_suppkey % 4 WHEN 1 THEN 'cast_' || s_suppkey || '_1.csv' WHEN 2 THEN 'cast_' || s_suppkey || '_9.csv'
                       WHEN 3 THEN 'missing_' || s_suppkey || '.csv' END AS ctd_file,
    CASE WHEN s_suppkey % 5 = 0 THEN 'suboceanexperiment_' || s_suppkey || '.txt' END AS subocean_file,
    CASE WHEN s_suppkey % 7 = 1 THEN 'KOR_' || s_suppkey || '.CSV' END AS exo_file,
    CASE WHEN s_suppkey % 7 = 2 THEN '_' || s_suppkey || '_b' END AS exo_file_2,
    CAST(60.0 + (s_suppkey % 50) * 0.01 AS DOUBLE) AS Latitude,
    CAST(-45.0 - (s_suppkey % 50) * 0.02 AS DOUBLE) AS Longitude
  FROM supplier
)"""

PROFILES = """
profiles AS (
  SELECT 'level2/cast_' || s_suppkey || '_' || n || '.csv' AS path, 'cast_' || s_suppkey || '_' || n || '.csv' AS name
  FROM supplier, (VALUES (1), (2)) v(n)
)"""

FILES = """
files AS (
  SELECT replace(p, '#', CAST(s_suppkey AS VARCHAR)) AS path
  FROM supplier, (VALUES ('raw/a/suboceanexperiment_#.txt'), ('raw/b/suboceanexperiment_#.txt'), ('raw/exo/kor_#.csv'),
    ('raw/exo/day_#_b_kor.csv'), ('raw/a-x/day_#_b_kor.csv'), ('raw/sb/cast_#.CNV'),
    ('raw/idro/20240703_#_Idronaut.txt'), ('raw/RBR/cast_#_data.txt'), ('raw/gf/ST#.TXT'), ('raw/doc/note_#.pdf')) v(p)
), parts AS (
  SELECT path, regexp_replace(path, '/[^/]*$', '') AS directory, regexp_extract(path, '[^/]*$') AS base_name,
    regexp_replace(regexp_extract(path, '[^/]*$'), '\\.[^.]*$', '') AS stem,
    lower(regexp_extract(path, '\\.[^./]*$')) AS extension
  FROM files
)"""

MATCHES = """
pairs AS (
  SELECT entry_no, min(path) AS path FROM logbook, profiles
  WHERE ctd_file = name OR (regexp_replace(name, '_?[^_]*$', '') <> ''
                            AND starts_with(ctd_file, regexp_replace(name, '_?[^_]*$', '')))
  GROUP BY entry_no
), matches AS (SELECT logbook.*, path FROM logbook JOIN pairs USING (entry_no))"""

E_PURE = "(z*(-270.983805184062+z*(776.153611613101+z*(-196.51255088122+(28.9796526294175-2.13290083518327*z)*z)))+y*(-24715.571866078+z*(2910.0729080936+z*(-1513.116771538718+z*(546.959324647056+z*(-111.1208127634436+8.68841343834394*z))))+y*(2210.2236124548363+z*(-2017.52334943521+z*(1498.081172457456+z*(-718.6359919632359+(146.4037555781616-4.9892131862671505*z)*z)))+y*(-592.743745734632+z*(1591.873781627888+z*(-1207.261522487504+(608.785486935364-105.4993508931208*z)*z))+y*(290.12956292128547+z*(-973.091553087975+z*(602.603274510125+z*(-276.361526170076+32.40953340386105*z)))+y*(-113.90630790850321+y*(21.35571525415769-67.41756835751434*z)+z*(381.06836198507096+z*(-133.7383902842754+49.023632509086724*z))))))))"
E_SALINE = "x2*(z*(729.116529735046+z*(-343.956902961561+z*(124.687671116248+z*(-31.656964386073+7.04658803315449*z))))+x*(x*(y*(-137.1145018408982+y*(148.10030845687618+y*(-68.5590309679152+12.4848504784754*y)))-22.6683558512829*z)+z*(-175.292041186547+(83.1923927801819-29.483064349429*z)*z)+y*(-86.1329351956084+z*(766.116132004952+z*(-108.3834525034224+51.2796974779828*z))+y*(-30.0682112585625-1380.9597954037708*z+y*(3.50240264723578+938.26075044542*z))))+y*(1760.062705994408+y*(-675.802947790203+y*(365.7041791005036+y*(-108.30162043765552+12.78101825083098*y)+z*(-1190.914967948748+(298.904564555024-145.9491676006352*z)*z))+z*(2082.7344423998043+z*(-614.668925894709+(340.685093521782-33.3848202979239*z)*z)))+z*(-1721.528607567954+z*(674.819060538734+z*(-356.629112415276+(88.4080716616-15.84003094423364*z)*z)))))"
G_PURE = "-24715.571866078+y*(4420.4472249096725+y*(-1778.231237203896+y*(1160.5182516851419+y*(-569.531539542516+y*128.13429152494615))))"
G_SALINE = "x2*(1760.062705994408+x*(-86.1329351956084+x*(-137.1145018408982+y*(296.20061691375236+y*(-205.67709290374563+49.9394019139016*y)))+y*(-60.136422517125+y*10.50720794170734))+y*(-1351.605895580406+y*(1097.1125373015109+y*(-433.20648175062206+63.905091254154904*y))))"
H_ALL = "61.01362420681071+y*(168776.46138048015+y*(-2735.2785605119625+y*(2574.2164453821433+y*(-1536.6644434977543+y*(545.7340497931629+(-50.91091728474331-18.30489878927802*y)*y)))))+x2*(268.5520265845071+y*(-12019.028203559312+y*(3734.858026725145+y*(-2046.7671145057618+y*(465.28655623826234+(-0.6370820302376359-10.650848542359153*y)*y))))+x*(937.2099110620707+y*(588.1802812170108+y*(248.39476522971285+(-3.871557904936333-2.6268019854268356*y)*y))+x*(-1687.914374187449+x*(246.9598888781377+x*(123.59576582457964-48.5891069025409*x))+y*(936.3206544460336+y*(-942.7827304544439+y*(369.4389437509002+(-33.83664947895248-9.987880382780322*y)*y))))))"


def put(formula, **values):
    """Replace the variables of a formula by SQL fragments."""
    return re.sub(r"\b(x2|x|y|z|SA|t|p|K|S|sat|R)\b", lambda m: f"({values[m[1]]})" if m[1] in values else m[1], formula)


def entropy(y, z):
    return put(f"(-0.025*(({E_PURE})+{E_SALINE}))", x2="x2", x="x", y=y, z=z)


def bend(y):
    return put(f"(0.000625*(({G_PURE})+{G_SALINE}))", x2="x2", x="x", y=y)


def volume(xs, ys, zs, axis=None):
    terms = []
    for key, c in VOLUME_TERMS.items():
        power = [int(d) for d in key]
        if axis is not None:
            c, power[axis] = c * power[axis], power[axis] - 1
        if min(power) >= 0:
            terms.append(f"{c!r}*pow({xs},{power[0]})*pow({ys},{power[1]})*pow({zs},{power[2]})")
    return "(" + "+".join(terms) + ")"


ROOT = "sqrt(0.0248826675584615*({0})+0.5971840214030754)"

DEPTH = """(2*c_/(b_+sqrt(b_*b_-4*a_*c_)))"""
DEPTH_B = "(9.780327*(1+(5.2792e-3+2.32e-5*pow(sin(radians(60)),2))*pow(sin(radians(60)),2)))"
DEPTH_A = "(-0.5*2.26e-7*" + DEPTH_B + ")"
DEPTH_C = ("(1e8*(p*1e-4)*(9.726613854843870e-4+(p*1e-4)*(-2.252956605630465e-5+(p*1e-4)*(2.376909655387404e-6+(p*1e-4)*"
           "(-1.664294869986011e-7+(p*1e-4)*(-5.988108894465758e-9+(p*1e-4)*(-2.1078768810e-9+2.8019291329e-10*(p*1e-4))"
           "))))))")


def depth(p):
    return DEPTH.replace("a_", DEPTH_A).replace("b_", DEPTH_B).replace("c_", put(DEPTH_C, p=p))


O2SOL = ("exp(5.80871+yy*(3.20291+yy*(4.17887+yy*(5.10006+yy*(-9.86643e-2+3.80369*yy))))+salinity_psu*(-7.01577e-3+yy*"
         "(-7.70028e-3+yy*(-1.13864e-2-9.51519e-3*yy))-2.75915e-7*salinity_psu))")
YY = "ln((298.15-1.00024*pot_temp_C)/(273.15+1.00024*pot_temp_C))"
MGKG = ("oxygen_saturation_percent/100*exp(-138.74202+1.572288e5/K-6.637149e7/pow(K,2)+1.243678e10/pow(K,3)-8.621061e11/"
        "pow(K,4)-salinity_psu*(0.020573-12.142/K+2363.1/pow(K,2)))")
MGL = ("oxygen_saturation_percent/100*1.428*exp(-173.4292+249.6339*100/K+143.3483*ln(K/100)-21.8492*K/100+salinity_psu*"
       "(-0.033096+0.014259*K/100-0.0017*pow(K/100,2)))")
KELVIN = "temperature_C+273.15"
TT = "(1.00024*temperature_C)"
RT = f"(0.6766097+{TT}*(2.00564e-2+{TT}*(1.104259e-4+{TT}*(-6.9698e-7+1.0031e-9*{TT}))))"
RATIO = "(conductivity_mS_per_m/42.914)"
RP = (f"(1+pressure_dbar*(2.070e-5+pressure_dbar*(-6.370e-10+3.989e-15*pressure_dbar))/(1+{TT}*(3.426e-2+4.464e-4*{TT})"
      f"+{RATIO}*(4.215e-1-3.107e-3*{TT})))")
PSS_ROOT = f"sqrt({RATIO}/({RP}*{RT}))"
PSS = ("(0.008+rr*(-0.1692+rr*(25.3851+rr*(14.0941+rr*(-7.0261+2.7081*rr))))+(TT-15)/(1+0.0162*(TT-15))*(0.0005+rr*"
       "(-0.0056+rr*(-0.0066+rr*(-0.0375+rr*(0.0636-0.0144*rr))))))").replace("TT", TT)


def clean(source="scans", key="cast_id"):
    """Offsets, corrected rows and the rows that survive (``base``)."""
    return f"""
thr AS (SELECT *, CASE WHEN ctd_type = 'exo' THEN 5 ELSE 0.15 END AS t FROM {source}),
air AS (
  SELECT {key}, count(*) AS n_air, median(pressure_dbar) AS p_off, median(oxygen_saturation_percent) - 100 AS o_raw,
         avg(PAR_umol_m2_s) AS PAR_avg_air
  FROM thr WHERE conductivity_mS_per_m < t GROUP BY {key}),
offs AS (
  SELECT {key}, n_air, p_off, CASE WHEN abs(o_raw) > 50 THEN 0 ELSE o_raw END AS o_off,
         coalesce(abs(o_raw) > 50, FALSE) AS bad, PAR_avg_air FROM air),
corr AS (
  SELECT thr.*, n_air, PAR_avg_air AS par_air,
         CASE WHEN n_air IS NULL THEN pressure_dbar ELSE pressure_dbar - p_off END AS p_c,
         CASE WHEN n_air IS NULL THEN oxygen_saturation_percent ELSE oxygen_saturation_percent - o_off END AS o_c,
         n_air IS NULL OR coalesce(conductivity_mS_per_m > t AND pressure_dbar - p_off > 0, FALSE) AS keep
  FROM thr LEFT JOIN offs USING ({key})),
kept AS (SELECT *, count(*) FILTER (WHERE keep) OVER (PARTITION BY {key}) AS nk FROM corr),
base AS (
  SELECT * EXCLUDE (pressure_dbar, oxygen_saturation_percent, p_c, o_c, par_air, n_air, t, keep, nk), nk > 0 AS processed,
         CASE WHEN nk > 0 THEN p_c ELSE pressure_dbar END AS pressure_dbar,
         CASE WHEN nk > 0 THEN o_c ELSE oxygen_saturation_percent END AS oxygen_saturation_percent,
         CASE WHEN nk > 0 THEN par_air END AS PAR_avg_air
  FROM kept WHERE keep OR nk = 0)"""


def properties(source="base"):
    """Salinity, temperatures, density, depth and oxygen as columns of ``props``."""
    start = ("temperature_C+ap*(8.65483913395442e-6-s1*1.41636299744881e-6-ap*7.38286467135737e-9+temperature_C*"
             "(-8.38241357039698e-6+s1*2.83933368585534e-8+temperature_C*1.77803965218656e-8+ap*1.71155619208233e-10))")
    return f"""
g1 AS (SELECT *, abs(pressure_dbar) AS ap, salinity_psu*35.16504/35 AS SA FROM {source}),
g2 AS (SELECT *, SA*35/35.16504 AS s1, 0.0248826675584615*SA AS x2, sqrt(0.0248826675584615*SA) AS x FROM g1),
g3 AS (SELECT *, {entropy("0.025*temperature_C", "1e-4*ap")} AS et, {start} AS o1 FROM g2),
g4 AS (SELECT *, 3991.86795711963/((273.15+o1)*(1-0.05*(1-SA/35.16504))) AS d1, {entropy("0.025*o1", "0")}-et AS e1 FROM g3),
g5 AS (SELECT *, -{bend("0.025*((o1-e1/d1)+o1)/2")} AS d2 FROM g4),
g6 AS (SELECT *, o1-e1/d2 AS o2 FROM g5),
g7 AS (SELECT *, {entropy("0.025*o2", "0")}-et AS e2 FROM g6),
g8 AS (SELECT *, -{bend("0.025*((o2-e2/d2)+o2)/2")} AS d3 FROM g7),
g9 AS (SELECT *, o2-e2/d3 AS pot_temp_C FROM g8),
g10 AS (SELECT *, ({put(H_ALL, x2="x2", x="x", y="0.025*pot_temp_C")})/3991.86795711963 AS CT FROM g9),
g11 AS (SELECT *, {ROOT.format("SA")} AS xs FROM g10),
g12 AS (SELECT *, 1/{volume("xs", "(0.025*CT)", "(1e-4*ap)")} AS density_kg_m3, {depth("pressure_dbar")} AS depth_m,
        {YY} AS yy, {KELVIN} AS K FROM g11),
props AS (SELECT *, {O2SOL}*0.022391 AS o2_solubility_mll, {O2SOL}*0.022391*1.42905 AS o2_solubility_mgl,
        {MGKG} AS o2_mgkg, {MGL} AS o2_mgl, {O2SOL} AS o2_umol FROM g12)"""


def n2(key="cast_id"):
    """Buoyancy frequency between kept rows (``mids``), and on the nearest scan (``n2``)."""
    return f"""
w AS (SELECT {key}, scan, ap, SA, CT FROM props WHERE processed),
w7 AS (SELECT * FROM (SELECT *, lead(ap) OVER (PARTITION BY {key} ORDER BY scan) AS np FROM w) WHERE np <> ap),
w8 AS (SELECT {key}, scan AS mid_no, ap, SA, CT, lead(ap) OVER o AS p2, lead(SA) OVER o AS s2, lead(CT) OVER o AS c2
       FROM w7 WINDOW o AS (PARTITION BY {key} ORDER BY scan)),
w9 AS (SELECT *, {ROOT.format("(SA+s2)/2")} AS xs, 0.025*(CT+c2)/2 AS ys, 1e-4*(ap+p2)/2 AS zs FROM w8 WHERE p2 IS NOT NULL),
w10 AS (SELECT *, {volume("xs", "ys", "zs")} AS v, {volume("xs", "ys", "zs", 0)} AS vx, {volume("xs", "ys", "zs", 1)} AS vy FROM w9),
mids AS (SELECT {key}, mid_no, (ap+p2)/2 AS p_mid,
         CASE WHEN p2 <> ap THEN 9.7963*9.7963*((-vx*0.0248826675584615/(2*xs)/v)*(s2-SA)-(0.025*vy/v)*(c2-CT))/(v*1e4*(p2-ap)) END AS N2 FROM w10),
pts AS (SELECT {key}, ap, min(scan) AS scan FROM w GROUP BY {key}, ap),
near AS (SELECT mids.{key}, mid_no, N2, arg_min(pts.scan, (abs(pts.ap - p_mid), pts.scan)) AS scan
         FROM mids JOIN pts USING ({key}) GROUP BY mids.{key}, mid_no, N2),
n2 AS (SELECT {key}, scan, arg_max(N2, mid_no) AS N2 FROM near GROUP BY {key}, scan)"""


def marks(key="cast_id"):
    return f"""
alive AS (SELECT * FROM props WHERE processed),
surf AS (SELECT {key}, arg_min_null(temperature_C, scan) AS t0, arg_min_null(density_kg_m3, scan) AS d0
         FROM alive WHERE pressure_dbar > 1 GROUP BY {key}),
mld AS (SELECT {key},
          arg_min(pressure_dbar, scan) FILTER (WHERE pressure_dbar > 1 AND abs(temperature_C - t0) > 0.2) AS mld_temp,
          arg_min(pressure_dbar, scan) FILTER (WHERE pressure_dbar > 1 AND abs(density_kg_m3 - d0) > 0.03) AS mld_dens
        FROM alive LEFT JOIN surf USING ({key}) GROUP BY {key}),
deep AS (SELECT {key}, min(scan) AS down_end FROM alive JOIN (
          SELECT {key}, max(depth_m) AS m FROM alive GROUP BY {key}) USING ({key}) WHERE depth_m = m GROUP BY {key})"""


def level2(key="cast_id"):
    """The processed table ``level2``."""
    on = "CASE WHEN processed THEN {0} END AS {0}"
    derived = ["pot_temp_C", "density_kg_m3", "mld_temp", "mld_dens", "o2_solubility_mll", "o2_solubility_mgl", "o2_mgkg",
               "o2_mgl", "N2", "depth_m"]
    return f"""
joined AS (SELECT props.*, mld_temp, mld_dens, down_end, N2, {PSS_ROOT} AS rr FROM props LEFT JOIN mld USING ({key})
           LEFT JOIN deep USING ({key}) LEFT JOIN n2 USING ({key}, scan)),
level2 AS (
  SELECT {key}, scan, ctd_type, timestamp, datetime, processed, pressure_dbar, temperature_C, conductivity_mS_per_m,
    oxygen_saturation_percent, PAR_umol_m2_s, PAR_avg_air,
    CASE WHEN processed AND NOT (ph BETWEEN 6 AND 9) THEN NULL ELSE ph END AS ph,
    CASE WHEN processed AND ctd_type = 'seabird' THEN {PSS} ELSE salinity_psu END AS salinity_psu,
    CASE WHEN processed AND ctd_type = 'seabird' THEN salinity_psu END AS salinity_psu_seabird,
    {", ".join(on.format(c) for c in derived)},
    CASE WHEN processed THEN scan <= down_end END AS is_downcast
  FROM joined)"""


def full(source="scans", key="cast_id"):
    return ",".join([clean(source, key), properties(), n2(key), marks(key), level2(key)])


STATIONED = """
combined AS (
  SELECT cast_id AS profile_name, scan, CAST(coalesce(timestamp, datetime) AS DATE) AS date,
    coalesce(timestamp, datetime) AS datetime, round(depth_m, 6) AS depth_m, round(pressure_dbar, 6) AS pressure_dbar,
    l.* EXCLUDE (depth_m, pressure_dbar, scan, timestamp, datetime),
    Station, station_ODV, Latitude, Longitude, coalesce(campaign, 'none') AS campaign
  FROM level2 l JOIN logbook b ON l.cast_id = 'cast_' || b.entry_no)"""

SMOOTH = """
n AS (SELECT cast_id, count(*) AS n FROM scans GROUP BY cast_id HAVING count(*) >= 21),
sm AS (
  SELECT a.cast_id, a.scan, sum(b.pressure_dbar * CASE
      WHEN a.scan < 10 THEN 1/21 + (a.scan-10)*(b.scan-10)/770 + 3*((a.scan-10)*(a.scan-10)-110/3)*((b.scan-10)*(b.scan-10)-110/3)/67298
      WHEN a.scan > n-11 THEN 1/21 + (a.scan-n+11)*(b.scan-n+11)/770 + 3*((a.scan-n+11)*(a.scan-n+11)-110/3)*((b.scan-n+11)*(b.scan-n+11)-110/3)/67298
      ELSE (329 - 5*(a.scan-b.scan)*(a.scan-b.scan))/3059 END ORDER BY b.scan) AS s
  FROM scans a JOIN n USING (cast_id) JOIN scans b ON a.cast_id = b.cast_id
   AND b.scan BETWEEN least(greatest(a.scan - 10, 0), n - 21) AND greatest(least(a.scan + 10, n - 1), 20)
  GROUP BY a.cast_id, a.scan),
runs AS (
  SELECT cast_id, g, any_value(s) AS s, min(scan) AS a, max(scan) AS b FROM (
    SELECT *, sum(ch) OVER (PARTITION BY cast_id ORDER BY scan) AS g FROM (
      SELECT *, CASE WHEN s = lag(s) OVER (PARTITION BY cast_id ORDER BY scan) THEN 0 ELSE 1 END AS ch FROM sm))
  GROUP BY cast_id, g),
minima AS (
  SELECT cast_id, (a + b) // 2 AS scan, s FROM (
    SELECT *, lag(s) OVER w AS ps, lead(s) OVER w AS ns FROM runs WINDOW w AS (PARTITION BY cast_id ORDER BY a))
  WHERE ps > s AND ns > s),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cast_id ORDER BY s, scan DESC) AS k FROM minima),
walk AS (
  SELECT cast_id, 1 AS k, [scan] AS kept FROM ranked WHERE k = 1
  UNION ALL
  SELECT w.cast_id, w.k + 1, CASE WHEN len(list_filter(w.kept, lambda v: abs(v - r.scan) < 50)) > 0 THEN w.kept
                                  ELSE list_append(w.kept, r.scan) END
  FROM walk w JOIN ranked r ON r.cast_id = w.cast_id AND r.k = w.k + 1),
thin AS (SELECT cast_id, unnest(kept) AS scan FROM (
  SELECT cast_id, arg_max(kept, k) AS kept FROM walk GROUP BY cast_id)),
cand AS (SELECT t.cast_id, t.scan, m.s FROM thin t JOIN minima m ON m.cast_id = t.cast_id AND m.scan = t.scan),
edge AS (
  SELECT c.cast_id, c.scan, c.s, coalesce(max(x.scan) FILTER (WHERE x.s < c.s AND x.scan < c.scan), -1) AS lo,
         coalesce(min(x.scan) FILTER (WHERE x.s < c.s AND x.scan > c.scan), 1000000000) AS hi
  FROM cand c JOIN sm x ON x.cast_id = c.cast_id GROUP BY c.cast_id, c.scan, c.s),
bounds AS (
  SELECT e.cast_id, e.scan FROM edge e JOIN sm x ON x.cast_id = e.cast_id AND x.scan > e.lo AND x.scan < e.hi
  GROUP BY e.cast_id, e.scan, e.s
  HAVING max(x.s) FILTER (WHERE x.scan < e.scan) >= e.s + 10 AND max(x.s) FILTER (WHERE x.scan > e.scan) >= e.s + 10),
starts AS (
  SELECT cast_id, scan AS "start" FROM bounds UNION ALL SELECT cast_id, 0 FROM scans WHERE scan = 0),
segs AS (
  SELECT cast_id, row_number() OVER (PARTITION BY cast_id ORDER BY "start") - 1 AS segment, "start",
    coalesce(lead("start") OVER (PARTITION BY cast_id ORDER BY "start"), z) AS "end"
  FROM starts JOIN (SELECT cast_id, max(scan) AS z FROM scans GROUP BY cast_id) USING (cast_id)),
named AS (
  SELECT segs.*, coalesce(strftime(timestamp, '%Y%m%d_%H%M%S'), s.cast_id) || '_' || (segment + 1) || '.csv' AS profile_name
  FROM segs JOIN scans s ON s.cast_id = segs.cast_id AND s.scan = segs."start")"""

DAILY = """
days AS (SELECT *, CAST(coalesce(first_value(timestamp) OVER f, first_value(datetime) OVER f) AS DATE) AS cast_date
         FROM scans WINDOW f AS (PARTITION BY cast_id ORDER BY scan)),
daily AS (
  SELECT * EXCLUDE (scan, cast_id), strftime(cast_date, '%Y-%m-%d') || '_' || ctd_type || '_concatenated' AS group_id,
    cast_id AS source_cast, scan AS source_scan,
    row_number() OVER (PARTITION BY cast_date, ctd_type ORDER BY datetime NULLS LAST, cast_id, scan) - 1 AS scan
  FROM days)"""


def rounded(names, digits=6):
    return ", ".join(f"round({n}, {digits}) + 0.0 AS {n}" for n in names.split())


def q(ctes, select, recursive=False):
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{select}"
