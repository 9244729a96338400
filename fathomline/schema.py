"""Standard columns, instrument column names and thresholds."""

from pyspark.sql import functions as F

# Instrument column name, standard column name, factor applied at ingest.
COLUMN_NAMES = {
    "idronaut": [
        ("Pres", "pressure_dbar", 1.0),
        ("Press", "pressure_dbar", 1.0),
        ("Temp", "temperature_C", 1.0),
        ("Cond", "conductivity_mS_per_m", 1.0),
        ("Sal", "salinity_psu", 1.0),
        ("O2%", "oxygen_saturation_percent", 1.0),
        ("O2ppm", "oxygen_concentration_ml_per_L", 0.7),
        ("Date", "date", 1.0),
        ("Time", "time", 1.0),
        ("PAR", "PAR_umol_m2_s", 1.0),
    ],
    "seabird": [
        ("prdM", "pressure_dbar", 1.0),
        ("depSM", "depth_m", 1.0),
        ("t090C", "temperature_C", 1.0),
        ("c0S/m", "conductivity_mS_per_m", 1000.0),
        ("sal00", "salinity_psu", 1.0),
        ("sbeox0PS", "oxygen_saturation_percent", 1.0),
        ("ph", "ph", 1.0),
        ("turbWETntu0", "turbidity_NTU", 1.0),
        ("flECO-AFL", "fluorescence_mg_m3", 1.0),
        ("oxsatML/L", "oxygen_concentration_ml_per_L", 1.0),
        ("scan", "scan", 1.0),
        ("flag", "flag", 1.0),
    ],
    "rbr": [
        ("Time", "timestamp", 1.0),
        ("Conductivity", "conductivity_mS_per_m", 1.0),
        ("Temperature", "temperature_C", 1.0),
        ("Pressure", "pressure_dbar", 1.0),
        ("Temperature.1", "temperature_secondary_C", 1.0),
        ("Dissolved O2 concentration", "oxygen_concentration_ml_per_L", 1.0),
        ("Sea pressure", "pressure_sea_dbar", 1.0),
        ("Depth", "depth_m", 1.0),
        ("Salinity", "salinity_psu", 1.0),
        ("Speed of sound", "sound_speed_m_per_s", 1.0),
        ("Specific conductivity", "conductivity_specific_mS_per_m", 0.1),
        ("Dissolved O2 saturation", "oxygen_saturation_percent", 1.0),
    ],
    "exo": [
        ("TIME (HH:MM:SS)", "time", 1.0),
        ("DATE (MM/DD/YYYY)", "date", 1.0),
        ("COND µS/CM", "conductivity_mS_per_m", 0.1),
        ("SPCOND µS/CM", "conductivity_specific_mS_per_m", 0.1),
        ("SAL PSU", "salinity_psu", 1.0),
        ("DEPTH M", "depth_m", 1.0),
        ("PRESSURE PSI A", "pressure_dbar", 0.689476),
        ("ODO % SAT", "oxygen_saturation_percent", 1.0),
        ("ODO MG/L", "oxygen_concentration_ml_per_L", 0.7),
        ("PH", "ph", 1.0),
        ("TEMP °C", "temperature_C", 1.0),
        ("TURBIDITY FNU", "turbidity_NTU", 1.0),
    ],
    "gf23": [
        ("Depth", "depth_m", 1.0),
        ("Temperature", "temperature_C", 1.0),
        ("Conductivity", "conductivity_mS_per_m", 1.0),
        ("Oxygen %", "oxygen_saturation_percent", 1.0),
        ("Oxygen mg/L", "oxygen_concentration_ml_per_L", 1.0),
        ("pH", "ph", 1.0),
        ("PAR", "PAR_umol_m2_s", 1.0),
        ("Salinity", "salinity_psu", 1.0),
        ("SigmaT", "sigma_t", 1.0),
        ("Trx-chl(a)", "chlorophyll_rfu", 1.0),
        ("Pressure", "pressure_dbar", 1.0),
        ("time In", "time", 1.0),
        ("date", "date", 1.0),
    ],
}

# The general parameter names and the standard column each one stands for.
COMMON_PARAMETERS = {
    "conductivity": "conductivity_mS_per_m",
    "pressure": "pressure_dbar",
    "temperature": "temperature_C",
    "salinity": "salinity_psu",
    "oxygen_saturation": "oxygen_saturation_percent",
    "oxygen_concentration": "oxygen_concentration_ml_per_L",
    "depth": "depth_m",
    "ph": "ph",
    "turbidity": "turbidity_NTU",
    "PAR": "PAR",
}

# The eleven columns of a GF23 file, which has no usable header line.
GF23_COLUMNS = [
    "Depth", "Temperature", "Conductivity", "Oxygen %", "Oxygen mg/L", "pH", "PAR", "Salinity", "SigmaT",
    "Trx-chl(a)", "Pressure",
]

# Site position, and the conductivity that separates air from water.
SITE_LATITUDE = 60.0
SITE_LONGITUDE = 60.0
AIR_CONDUCTIVITY = 0.15
AIR_CONDUCTIVITY_EXO = 5.0

# Columns process_casts needs; anything else in the input travels along unchanged.
REQUIRED_COLUMNS = [
    "scan", "ctd_type", "pressure_dbar", "temperature_C", "conductivity_mS_per_m", "salinity_psu",
    "oxygen_saturation_percent",
]

# Measures a campaign dashboard averages or sums.
MEASURES = [
    "N2", "PAR_avg_air", "PAR_umol_m2_s", "chlorophyll_rfu", "conductivity_mS_per_m", "density_kg_m3", "mld_dens",
    "mld_temp", "o2_mgkg", "o2_mgl", "o2_solubility_mgl", "o2_solubility_mll", "oxygen_concentration_ml_per_L",
    "oxygen_saturation_percent", "ph", "pot_temp_C", "pressure_dbar", "salinity_psu", "sigma_t", "temperature_C",
]


def standard_names(ctd_type):
    """Standard name -> list of instrument names in table order."""
    names = {}
    for raw, standard, _ in COLUMN_NAMES[ctd_type.lower()]:
        names.setdefault(standard, []).append(raw)
    return names


def factor_of(standard, ctd_type):
    """Factor that turns the instrument's unit into the standard one."""
    return next((f for _, s, f in COLUMN_NAMES[ctd_type.lower()] if s == standard), 1.0)


def mapping_table(spark):
    """The column names as a small table ``(ctd_type, position, raw_name, std_name, factor)``."""
    rows = [(kind, i, raw, standard, factor)
            for kind, entries in COLUMN_NAMES.items()
            for i, (raw, standard, factor) in enumerate(entries)]
    return spark.createDataFrame(rows, "ctd_type string, position int, raw_name string, std_name string, factor double")


def require(df, columns):
    """Fail early, with the names, when ``df`` lacks columns an operator needs."""
    present = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in present]
    if missing:
        raise ValueError(f"missing columns {missing}; present: {df.columns}")
    return df
