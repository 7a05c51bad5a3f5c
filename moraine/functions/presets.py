"""Named regions, periods and organism groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (young, old) bounds of periods in years before present.
PERIODS_BP = {
    "all": (None, None), "quaternary": (0, 2580000), "pleistocene": (11700, 2580000), "holocene": (0, 11700), "late_pleistocene": (11700, 129000),
    "middle_pleistocene": (129000, 774000), "early_pleistocene": (774000, 2580000), "late_quaternary": (0, 129000), "lgm": (19000, 26500),
    "last_glacial": (11700, 115000), "pliocene": (2580000, 5333000), "neogene": (2580000, 23030000), "cenozoic": (0, 66000000),
}
# Bounding boxes (least longitude, least latitude, greatest longitude, greatest latitude).
REGIONS = {
    "global": (-180.0, -90.0, 180.0, 90.0), "world": (-180.0, -90.0, 180.0, 90.0), "northern_hemisphere": (-180.0, 0.0, 180.0, 90.0),
    "southern_hemisphere": (-180.0, -90.0, 180.0, 0.0), "holarctic": (-180.0, 20.0, 180.0, 90.0), "nearctic": (-170.0, 15.0, -50.0, 85.0),
    "palearctic": (-25.0, 20.0, 180.0, 85.0), "north_america": (-170.0, 5.0, -50.0, 85.0), "canada": (-142.0, 41.0, -52.0, 84.0),
    "usa": (-170.0, 18.0, -65.0, 72.0), "eurasia": (-25.0, 0.0, 180.0, 85.0), "europe": (-25.0, 34.0, 45.0, 72.0), "asia": (25.0, -10.0, 180.0, 85.0),
    "africa": (-20.0, -35.0, 55.0, 38.0), "south_america": (-82.0, -56.0, -34.0, 13.0), "australia": (110.0, -45.0, 155.0, -10.0),
    "tanzania": (29.0, -12.5, 41.5, -0.5), "east_africa": (21.0, -12.5, 52.0, 18.5), "beringia": (-180.0, 50.0, -120.0, 75.0),
}
ALIASES = {"north_hemisphere": "northern_hemisphere", "united_states": "usa"}
# Kingdom, phylum and organism group of collection group codes.
GROUP_CODES = {
    **dict.fromkeys(("MAM", "AVE", "BRD", "FSH", "FIS", "HERP", "REP", "AMP"), ("Animalia", "Chordata", "animals")),
    **dict.fromkeys(("BTL", "INS", "CHI", "CLA", "OST", "COP"), ("Animalia", "Arthropoda", "animals")), "MOL": ("Animalia", "Mollusca", "animals"),
    **dict.fromkeys(("VPL", "PLT", "PTE"), ("Plantae", "Tracheophyta", "plants")), "BRY": ("Plantae", "Bryophyta", "plants"), "ALG": ("Plantae", "", "plants"),
    "FNG": ("Fungi", "", "fungi"), "FUN": ("Fungi", "", "fungi"), "DIA": ("Chromista", "Bacillariophyta", "diatoms"), "FOR": ("Rhizaria", "Foraminifera", "protists"),
}
# Words of a dataset type, then endings of a name, that tell the same.
TYPE_WORDS = (
    (("vertebrate", "fauna", "fish", "herp", "mammal", "bird"), ("Animalia", "Chordata", "animals")), (("mollusk", "mollusc"), ("Animalia", "Mollusca", "animals")),
    (("insect", "beetle", "ostracod", "cladocera", "chironomid"), ("Animalia", "Arthropoda", "animals")), (("pollen", "plant", "macrofossil"), ("Plantae", "Tracheophyta", "plants")),
    (("fung", "spore"), ("Fungi", "", "fungi")), (("diatom",), ("Chromista", "Bacillariophyta", "diatoms")),
)
NAME_ENDS = ((r"(?i)aceae\b", ("Plantae", "", "plants")), (r"(?i)idae\b", ("Animalia", "", "animals")))
# Phyla of animals, plants and fungi, vertebrate classes, and organism words that mean animals.
ANIMAL_PHYLA = ("Chordata", "Arthropoda", "Mollusca", "Annelida", "Brachiopoda", "Bryozoa", "Echinodermata", "Cnidaria", "Porifera", "Hemichordata", "Nematoda", "Platyhelminthes", "Priapulida", "Onychophora", "Tardigrada", "Rotifera")
PLANT_PHYLA = ("Tracheophyta", "Streptophyta", "Bryophyta", "Anthophyta", "Magnoliophyta", "Pinophyta", "Lycopodiophyta", "Pteridophyta", "Charophyta", "Chlorophyta")
FUNGUS_PHYLA = ("Ascomycota", "Basidiomycota", "Glomeromycota", "Chytridiomycota")
VERTEBRATES = ("Mammalia", "Aves", "Reptilia", "Amphibia", "Actinopterygii", "Chondrichthyes")
CHORDATE_WORDS = ("mammals", "birds", "fish", "reptiles", "amphibians", "vertebrates", "reptiles_amphibians")
ANIMAL_WORDS = (*CHORDATE_WORDS, "animals", "metazoa", "invertebrates", "arthropods", "molluscs")


# Continents as the source names them with their short names, groups of them, bases of record, and the dataset
# types that an organism word asks for.
CONTINENTS = {**{c.lower(): c for c in ("NORTH_AMERICA", "SOUTH_AMERICA", "EUROPE", "ASIA", "AFRICA", "OCEANIA", "ANTARCTICA")}, "na": "NORTH_AMERICA", "sa": "SOUTH_AMERICA", "eu": "EUROPE"}
CONTINENT_GROUPS = {
    "northern_hemisphere": ("NORTH_AMERICA", "EUROPE", "ASIA"), "holarctic": ("NORTH_AMERICA", "EUROPE", "ASIA"), "americas": ("NORTH_AMERICA", "SOUTH_AMERICA"),
    "eurasia": ("EUROPE", "ASIA"), "old_world": ("EUROPE", "ASIA", "AFRICA"),
}
BASES = {
    "human": ("HUMAN_OBSERVATION", "PRESERVED_SPECIMEN", "OBSERVATION", "LITERATURE", "MATERIAL_CITATION"), "observed": ("HUMAN_OBSERVATION", "OBSERVATION"),
    "specimen": ("PRESERVED_SPECIMEN",), "machine": ("MACHINE_OBSERVATION",), "fossil": ("FOSSIL_SPECIMEN",), "living": ("LIVING_SPECIMEN",), "any": (),
}


def continents(names: list[str]) -> list[str]:
    """Source names of continents, short names and groups, in order, each once; others go in upper case as they are."""
    out = []
    for n in names:
        k = n.strip().lower().replace("-", "_").replace(" ", "_")
        out += CONTINENT_GROUPS.get(k) or [CONTINENTS.get(k, n.strip().upper())]
    return list(dict.fromkeys(out))


def requested(region_name: str | None = None, countries: list[str] = (), continent_names: list[str] = (), basis: str = "any", years: tuple | None = None, with_coordinates: bool = False) -> list[dict]:
    """The source's filter as a list of conditions that must all hold: boxes and lists are alternatives within one."""
    out = []
    if region_name and key(region_name) not in ("global", "world"):
        a, b, c, d = region(region_name)
        out.append({"type": "and", "predicates": [{"type": "range", "key": k, "value": {"gte": lo, "lte": hi}} for k, lo, hi in (("DECIMAL_LONGITUDE", a, c), ("DECIMAL_LATITUDE", b, d))]})
    for k, values in (("COUNTRY", [c.strip().upper() for c in countries]), ("CONTINENT", continents(list(continent_names))), ("BASIS_OF_RECORD", list(BASES[basis]))):
        if values:
            out.append({"type": "or", "predicates": [{"type": "equals", "key": k, "value": v} for v in values]} if len(values) > 1 else {"type": "equals", "key": k, "value": values[0]})
    if years:
        out.append({"type": "range", "key": "YEAR", "value": {"gte": years[0], "lte": years[1]}})
    return out + [{"type": "equals", "key": "HAS_COORDINATE", "value": "true"}] * with_coordinates


def matching(lat: Column, lon: Column, country: Column, continent: Column, basis: Column, conditions: list[dict]) -> Column:
    """The same filter on rows that are there."""
    by = {"DECIMAL_LONGITUDE": lon, "DECIMAL_LATITUDE": lat, "COUNTRY": F.upper(country), "CONTINENT": F.upper(continent), "BASIS_OF_RECORD": F.upper(basis)}

    def test(c):
        if c["type"] in ("and", "or"):
            parts = [test(p) for p in c["predicates"]]
            out = parts[0]
            for p in parts[1:]:
                out = out & p if c["type"] == "and" else out | p
            return out
        if c["type"] == "range":
            return by[c["key"]].between(c["value"]["gte"], c["value"]["lte"])
        return lat.isNotNull() & lon.isNotNull() if c["key"] == "HAS_COORDINATE" else by[c["key"]] == c["value"]

    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(test(c), F.lit(False))
    return out


def geojson_wkt(shape: dict) -> str:
    """POLYGON or MULTIPOLYGON of a geometry, a feature, or a collection's first feature; rings are closed."""

    def ring(points):
        if not points:
            raise ValueError("a ring without points")
        p = [(float(x), float(y)) for x, y, *_ in points]
        return "(" + ", ".join(f"{x} {y}" for x, y in (p if p[0] == p[-1] else [*p, p[0]])) + ")"

    if shape.get("type") == "FeatureCollection":
        if not shape.get("features"):
            raise ValueError("a collection without features")
        shape = shape["features"][0]
    if shape.get("type") == "Feature":
        shape = shape.get("geometry") or {}
    rings = lambda polygon: ", ".join(map(ring, polygon))
    if shape.get("type") == "Polygon":
        return f"POLYGON ({rings(shape['coordinates'])})"
    if shape.get("type") == "MultiPolygon":
        return f"MULTIPOLYGON ({', '.join(f'({rings(p)})' for p in shape['coordinates'])})"
    raise ValueError(f"no polygon: {shape.get('type')}")


def key(name: str) -> str:
    k = (name or "global").strip().lower().replace("-", "_").replace(" ", "_")
    return ALIASES.get(k, k)


def region(name: str | None = None, bbox: str | None = None) -> tuple[float, float, float, float]:
    """A preset's box, or that of "minLon,minLat,maxLon,maxLat"."""
    if bbox:
        parts = [float(p) for p in bbox.split(",")]
        if len(parts) != 4:
            raise ValueError("a box has four numbers")
        return tuple(parts)
    return REGIONS[key(name)]


def period(name: str | None = None, young: float | None = None, old: float | None = None, unit: str = "bp") -> tuple[float | None, float | None]:
    """(young, old) in the unit; own bounds win over a preset's."""
    a, b = PERIODS_BP[key(name or "all")]
    scale = {"bp": 1, "ka": 1e3, "ma": 1e6}[unit]
    own = lambda x: None if x is None else x / scale
    a, b = young if young is not None else own(a), old if old is not None else own(b)
    if a is not None and b is not None and a > b:
        raise ValueError("young is older than old")
    return a, b


def wkt(box: tuple[float, float, float, float]) -> str:
    """POLYGON of a box; one over the antimeridian or all round becomes two, closed at 0 and short of 180."""
    ring = lambda a, b, c, d: f"(({a:g} {b:g}, {c:g} {b:g}, {c:g} {d:g}, {a:g} {d:g}, {a:g} {b:g}))"
    a, b, c, d = box
    if a > c or c - a >= 359:
        west, east = (max(a, -178), min(c, 178)) if a <= c else (-178, 178)
        parts = (ring(west, b, 0, d), ring(0, b, east, d)) if a <= c else (ring(a, b, east, d), ring(west, b, c, d))
        return f"MULTIPOLYGON({', '.join(parts)})"
    return f"POLYGON{ring(a, b, c, d)}"


def inside(lat: Column, lon: Column, box: tuple[float, float, float, float], require: bool = False) -> Column:
    """In the box, edges included, over the antimeridian where its least longitude is the greater; rows without coordinates pass unless required."""
    a, b, c, d = box
    x = lon.between(a, c) if a <= c else (lon >= a) | (lon <= c)
    return F.when(lat.isNull() | lon.isNull(), F.lit(not require)).otherwise(lat.between(b, d) & x)


def overlaps(young: Column, old: Column, bounds: tuple[float | None, float | None], require: bool = False) -> Column:
    """The row's age range meets the wanted one. Rows are compared only where all four bounds are known: one with an unknown
    age passes (if ages are required, one of them must be known), and one open end of the wanted range lets every row pass."""
    some = young.isNotNull() | old.isNotNull() if require else F.lit(True)
    if bounds[0] is None or bounds[1] is None:
        return some
    return some & F.when(young.isNull() | old.isNull(), True).otherwise((old >= bounds[0]) & (young <= bounds[1]))


def group_of(code: Column, dataset_type: Column, name: Column) -> Column:
    """struct(kingdom, phylum, organism, source) by group code, then dataset type, then the name's ending."""
    made = lambda v, src: F.struct(F.lit(v[0]).alias("kingdom"), F.lit(v[1]).alias("phylum"), F.lit(v[2]).alias("organism"), src.alias("source"))
    tg, dt = F.upper(F.trim(F.coalesce(code, F.lit("")))), F.lower(F.coalesce(dataset_type, F.lit("")))
    out = None
    for k, v in GROUP_CODES.items():
        value = made(v, F.concat(F.lit("taxagroupid:"), tg))
        out = F.when(tg == k, value) if out is None else out.when(tg == k, value)
    for words, v in TYPE_WORDS:
        out = out.when(dt.rlike("|".join(words)), made(v, F.lit("datasettype")))
    for rx, v in NAME_ENDS:
        out = out.when(F.coalesce(name, F.lit("")).rlike(rx), made(v, F.lit("name_suffix")))
    return out.otherwise(made(("Unknown", "", "unknown"), F.lit("unknown")))


def kingdom_phylum(kingdom: Column, phylum: Column, klass: Column, organisms: str = "") -> Column:
    """struct(kingdom, phylum) as recorded, else by phylum or class, else by the organisms asked for."""
    k, p, c = (F.coalesce(x, F.lit("")) for x in (kingdom, phylum, klass))
    made = lambda a, b: F.struct(a.alias("kingdom"), b.alias("phylum"))
    chordate = F.when(p == "", "Chordata").otherwise(p)
    hint = organisms.lower()
    last = made(F.lit("Animalia"), chordate if hint in CHORDATE_WORDS else p) if hint in ANIMAL_WORDS else made(F.lit({"plants": "Plantae", "fungi": "Fungi"}.get(hint, "Unknown")), p)
    return F.when(k != "", made(k, p)).when(p.isin(*ANIMAL_PHYLA) | c.isin(*VERTEBRATES), made(F.lit("Animalia"), chordate)).when(p.isin(*PLANT_PHYLA), made(F.lit("Plantae"), p)).when(p.isin(*FUNGUS_PHYLA), made(F.lit("Fungi"), p)).otherwise(last)
