"""Fixed domain values: variables, units, ranges, aliases and patterns.

Everything in this module is a constant of the domain.  Each table is far below
a hundred rows, so operators turn it into a literal expression instead of a join.
"""

# --- fixed values: variables -----------------------------------------------

VARIABLES = (
    "active_layer_thickness",
    "soil_temperature",
    "ground_temperature",
    "volumetric_ice_content",
    "excess_ice_content",
    "volumetric_water_content",
    "thaw_event_label",
    "land_surface_temperature",
    "surface_deformation",
    "ndvi",
    "elevation",
    "snow_depth",
    "precipitation",
    "air_temperature",
)

# --- fixed values: canonical unit per measured variable --------------------
CANONICAL_UNIT = {
    "active_layer_thickness": "m",
    "soil_temperature": "degC",
    "ground_temperature": "degC",
    "volumetric_ice_content": "1",
    "excess_ice_content": "1",
    "volumetric_water_content": "1",
    "ndvi": "1",
    "elevation": "m",
    "snow_depth": "m",
    "land_surface_temperature": "degC",
    "surface_deformation": "mm",
    "precipitation": "mm/day",
    "air_temperature": "degC",
}

# --- fixed values: inclusive physical bounds, in canonical units -----------
VALID_RANGE = {
    "active_layer_thickness": (0.0, 10.0),
    "soil_temperature": (-60.0, 40.0),
    "ground_temperature": (-60.0, 40.0),
    "volumetric_ice_content": (0.0, 1.0),
    "excess_ice_content": (0.0, 1.0),
    "volumetric_water_content": (0.0, 1.0),
    "ndvi": (-1.0, 1.0),
    "elevation": (-500.0, 9000.0),
    "snow_depth": (0.0, 30.0),
    "land_surface_temperature": (-60.0, 50.0),
    "surface_deformation": (-1000.0, 1000.0),
    "precipitation": (0.0, 2000.0),
    "air_temperature": (-70.0, 50.0),
}

# --- fixed values: variables that need a depth -----------------------------
SUBSURFACE = (
    "excess_ice_content",
    "ground_temperature",
    "soil_temperature",
    "volumetric_ice_content",
    "volumetric_water_content",
)

# --- fixed values: variables that route together ---------------------------
EQUIVALENT_VARIABLES = (("soil_temperature", "ground_temperature"),)

# --- fixed values: unit spellings and linear conversions -------------------
UNIT_ALIAS = {
    "fraction": "1",
    "dimensionless": "1",
    "percent": "%",
    "deg_c": "degC",
    "degc": "degC",
    "celsius": "degC",
    "degree_celsius": "degC",
}

# (from, to) -> (scale, offset)
UNIT_CONVERSION = {
    ("cm", "m"): (0.01, 0.0),
    ("mm", "m"): (0.001, 0.0),
    ("m", "cm"): (100.0, 0.0),
    ("m", "mm"): (1000.0, 0.0),
    ("K", "degC"): (1.0, -273.15),
    ("degC", "K"): (1.0, 273.15),
    ("%", "1"): (0.01, 0.0),
    ("1", "%"): (100.0, 0.0),
}

# --- fixed values: declared column names -> variable -----------------------
VARIABLE_ALIAS = {
    "soil_temperature": "soil_temperature",
    "temperature": "soil_temperature",
    "temp": "soil_temperature",
    "volumetric_soil_moisture": "volumetric_water_content",
    "soil_moisture": "volumetric_water_content",
    "thaw_depth": "active_layer_thickness",
    "active_layer_thickness": "active_layer_thickness",
    "air_temperature": "air_temperature",
    "ground_temperature": "ground_temperature",
    "land_surface_temperature": "land_surface_temperature",
    "snow_depth": "snow_depth",
    "ndvi": "ndvi",
    "elevation": "elevation",
    "precipitation": "precipitation",
    "volumetric_ice_content": "volumetric_ice_content",
    "excess_ice_content": "excess_ice_content",
    "eic": "excess_ice_content",
    "vmc": "volumetric_water_content",
}

# --- fixed values: file classification -------------------------------------
FORMAT_BY_SUFFIX = {
    ".csv": "csv",
    ".tsv": "tsv",
    ".pdf": "pdf",
    ".xml": "xml",
    ".nc": "netcdf",
    ".tif": "geotiff",
    ".tiff": "geotiff",
    ".txt": "text",
    ".json": "json",
    ".md": "markdown",
}

BAG_FILES = ("bagit.txt", "bag-info.txt", "manifest-md5.txt", "tagmanifest-md5.txt")

ROOT_SIDECARS = (
    "PROVENANCE.json",
    "CITATION.cff",
    "README.md",
    "metadata.txt",
    "metadata.json",
)

REQUIRED_STAGED_FILES = ("PROVENANCE.json", "CITATION.cff", "README.md")
NATIVE_METADATA_FILES = ("metadata.json", "metadata.txt")

DICTIONARY_COLUMNS = ("Column_or_Row_Name", "Unit", "Definition")

# --- fixed values: thaw feature categories, index = position ----------------
FEATURE_CATEGORIES = (
    "Active layer detachment",
    "Retrogressive thaw slump",
    "Thaw pond",
    "Thermoerosional gully",
    "Thermokarst",
    "Thermokarst lake",
    "Thermokarst wetland",
    "Wildfire-induced thaw",
    "Non-abrupt",
)

# --- fixed values: text patterns (Java regex) -------------------------------
DOI_IN_TEXT = r"10\.\d{4,9}/[^\s\"'<>)\];,]+"
DOI_IN_REFERENCE = r"(?i)10\.\d{4,9}/[-._;()/:A-Z0-9]+"

SECRET_RULES = (
    ("Anthropic API key", r"sk-ant-[A-Za-z0-9_\-]{20,}"),
    ("OpenAI project API key", r"sk-proj-[A-Za-z0-9_\-]{20,}"),
    ("AWS access key id", r"\bAKIA[0-9A-Z]{16}\b"),
    (
        "AWS secret access key",
        r"AWS_SECRET_ACCESS_KEY\s*=\s*['\"][A-Za-z0-9/+=]{40}['\"]",
    ),
    ("JWT", r"\beyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+"),
    ("GitHub fine-grained PAT", r"github_pat_[A-Za-z0-9_]{20,}"),
    ("GitHub classic PAT", r"\bghp_[A-Za-z0-9]{36}\b"),
)

SECRET_SCAN_SKIP_SUFFIXES = (
    ".png",
    ".jpg",
    ".jpeg",
    ".pdf",
    ".nc",
    ".tif",
    ".tiff",
    ".parquet",
    ".h5",
    ".hdf5",
    ".gz",
    ".zip",
)

# --- fixed values: relevance ratings -----------------------------------------
RELEVANCE = ("HIGH", "MEDIUM", "LOW", "IRRELEVANT")

# --- fixed values: geodesy -----------------------------------------------------
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.0
STORAGE_CRS = "EPSG:4326"
ANALYSIS_CRS = "EPSG:3338"
SCHEMA_VERSION = "0.1.0"
