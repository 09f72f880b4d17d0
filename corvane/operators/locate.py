"""Places in free text to country and subdivision codes, by lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import apply_steps, strip_junk
from corvane.operators.relational import MOST_BROADCAST_ROWS, small
from corvane.shared import written

# What is stripped from a place before it's looked up, in order.
PLACE_STEPS = (
    (r"(?i)(an? )([^\(]+?) (corporation|company|(general )?partnership|corp)\)?.*", "$2"),
    (r"(?i)^incorporated in ((the )?state of )?(.*)$", "$3"),
    (r"(?i)^.*(incorporated|amalgamated|organized) under the laws of (the )?(.*)$", "$3"),
    (r"\(\d{4}\)$", ""),
    (r"(?i) (LLC|Statutory Trust|General Part(nership)?|private|banking|special|closed)*$", ""),
    (r"(?i)^(incorporation|formed in)*:? ", ""),
    (r"[\d\.,]+%(-NV)? ?", ""),
    (r"^([^,]+) ?- ?([^,]+)$", "$1, $2"),
    (r"(?i)(corporation|company|organization|(general )?partnership|corp)$", ""),
    # only the first pair of parentheses, whose text is dropped; Java replaces all unless what is before is matched, too
    (r"(?s)^(.*?)\(([^\)]+)\)", "$1, "),
)


def clean_place(text: Column) -> Column:
    """The place in a phrase such as "a Delaware corporation" or "organized under the laws of Ireland"."""
    return strip_junk(apply_steps(strip_junk(text), PLACE_STEPS))


def _key(c: str | Column) -> Column:
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def _first(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """One row a key: the smallest by order (nulls first), so that ties are the same every time."""
    rest = [c for c in order if c not in keys]
    return df.filter(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_m")).select(*keys, "_m.*")


class Places:
    """Lookup tables of countries, their aliases (some of subdivisions) and subdivisions.

    countries: country_code, country_name. aliases: country_code, country_name, subdiv_code (null: the country itself).
    subdivisions: country_code, subdivision_code, subdivision_name. Comparisons ignore case. Where several rows match, countries come
    before aliases, then the smallest codes win. What a text can mean is one table, broadcast if it's small enough.
    """

    def __init__(self, countries: DataFrame, aliases: DataFrame, subdivisions: DataFrame):
        country = countries.select(_key("country_name").alias("k"), F.lit(0).alias("p"), F.col("country_code").alias("cc"))
        alias = aliases.filter("subdiv_code is null").select(_key("country_name").alias("k"), F.lit(1).alias("p"), F.col("country_code").alias("cc"))
        of_alias = aliases.filter("subdiv_code is not null")
        sub = subdivisions.select(
            F.col("country_code").alias("cc"), F.col("subdivision_code").alias("sc"), _key("subdivision_code").alias("code"), _key("subdivision_name").alias("name")
        )
        by_name = sub.select("cc", "sc", F.col("name").alias("k"), F.lit(0).alias("p")).unionByName(
            of_alias.select(F.col("country_code").alias("cc"), F.col("subdiv_code").alias("sc"), _key("country_name").alias("k"), F.lit(1).alias("p"))
        )
        by_code = sub.select("cc", "sc", F.col("code").alias("k"), F.lit(0).alias("p")).unionByName(
            of_alias.select(F.col("country_code").alias("cc"), F.col("subdiv_code").alias("sc"), _key("country_code").alias("k"), F.lit(1).alias("p"))
        )
        states = sub.filter("cc = 'US'")
        us = states.select("cc", "sc", F.col("code").alias("k"), F.lit(0).alias("p")).unionByName(states.select("cc", "sc", F.col("name").alias("k"), F.lit(1).alias("p")))
        coded = country.unionByName(countries.select(_key("country_code").alias("k"), F.lit(1).alias("p"), F.col("country_code").alias("cc")))
        every_alias = aliases.select(_key("country_name").alias("k"), F.col("country_code").alias("cc"), F.col("subdiv_code").alias("sc"))
        whole = sub.select("cc", "sc", F.col("code").alias("k"), F.lit(0).alias("p")).unionByName(
            sub.filter("sc <> 'I'").select("cc", "sc", F.col("name").alias("k"), F.lit(1).alias("p"))
        )
        tables = {
            "country": _first(country.unionByName(alias), ["k"], "p", "cc").select("k", "cc"),
            "within": _first(by_name, ["cc", "k"], "p", "sc").select("cc", "k", "sc"),
            "any_name": _first(by_name, ["k"], "p", "cc", "sc").select("k", "cc", "sc"),
            "any_code": _first(by_code, ["k"], "p", "cc", "sc").select("k", "cc", "sc"),
            "us": _first(us, ["k"], "p", "sc", "cc").select("k", "cc", "sc"),
            "name_or_code": _first(coded, ["k"], "p", "cc").select("k", "cc"),
            "alias": _first(every_alias, ["k"], "cc", "sc").select("k", "cc", "sc"),
            "any_sub": _first(whole, ["k"], "p", "cc", "sc").select("k", "cc", "sc"),
        }
        # one table of what a text can mean, keyed by the text and written once: a column for each kind of meaning
        every = None
        for name, table in tables.items():
            rows = table.select(F.lit(name).alias("of"), "k", "cc", "sc" if "sc" in table.columns else F.lit(None).cast("string").alias("sc"))
            every = rows if every is None else every.unionByName(rows)
        meaning = F.struct("cc", "sc")
        kinds = [F.first(F.when(F.col("of") == name, meaning), ignorenulls=True).alias(name) for name in tables if name != "within"]
        within = F.map_from_entries(F.collect_list(F.when(F.col("of") == "within", meaning))).alias("within")
        made = written(every.groupBy("k").agg(*kinds, within), "places")
        rows = made.select("k", F.struct(*[c for c in made.columns if c != "k"]).alias("m"))
        self.meanings = F.broadcast(rows) if made.limit(MOST_BROADCAST_ROWS + 1).count() <= MOST_BROADCAST_ROWS else rows


def look_up(texts: DataFrame, place: str, places: Places, clean: bool = True) -> DataFrame:
    """texts with country_code, subdiv_code and place_clean; null codes where nothing matches.

    A mention of Delaware decides. "first, second" is tried as subdivision and country in both orders, then as a subdivision of
    any country by name, then by code. What is left, and every text without a comma, is looked up whole: a US state by code or
    name, a country by name or code, an alias, any subdivision.
    """
    d = texts.withColumn("place_clean", clean_place(F.col(place)) if clean else F.col(place))
    d = d.withColumn("_whole", _key("place_clean"))
    parts = F.split("place_clean", ", ?", 2)
    comma = F.col("place_clean").contains(",")
    d = d.withColumn("_first", F.when(comma, _key(parts[0]))).withColumn("_second", F.when(comma, _key(parts[1])))
    form = r"^(?:inc|ltd|llc|.|[0-9]+)$"
    void = (F.length("place_clean") <= 1) | F.coalesce(F.col("_first").rlike(form) | F.col("_second").rlike(form), F.lit(False))
    for c in ("_first", "_second", "_whole"):
        d = d.join(places.meanings.withColumnsRenamed({"k": f"{c}_k", "m": f"{c}_m"}), F.col(c) == F.col(f"{c}_k"), "left")
    one, two, whole = F.col("_first_m"), F.col("_second_m"), F.col("_whole_m")
    country = F.coalesce(two["country"]["cc"], one["country"]["cc"])
    within = F.when(two["country"].isNotNull(), F.try_element_at(one["within"], country)).otherwise(F.try_element_at(two["within"], country))
    either = lambda x, y: F.when(x.isNull() | (y < x), y).otherwise(x)
    pair = F.coalesce(either(one["any_name"], two["any_name"]), either(one["any_code"], two["any_code"]))
    coded = F.when(whole["name_or_code"].isNotNull(), F.struct(whole["name_or_code"]["cc"].alias("cc"), F.lit(None).cast("string").alias("sc")))
    found = (
        F.when(F.lower("place_clean").contains("delaware"), F.struct(F.lit("US").alias("cc"), F.lit("DE").alias("sc")))
        .when(void, F.lit(None))
        .when(country.isNotNull(), F.struct(country.alias("cc"), within.alias("sc")))
        .otherwise(F.coalesce(pair, whole["us"], coded, whole["alias"], whole["any_sub"]))
    )
    d = d.withColumn("_found", found).withColumn("country_code", F.col("_found.cc")).withColumn("subdiv_code", F.col("_found.sc"))
    return d.select(*texts.columns, "place_clean", "country_code", "subdiv_code")


def resolve_places(df: DataFrame, place: str, places: Places, clean: bool = True) -> DataFrame:
    """df with the columns that look_up() adds. Each distinct text is cleaned and looked up once."""
    texts = df.select(F.col(place).alias("_text")).filter("_text is not null").distinct()
    return df.join(look_up(texts, "_text", places, clean), F.col(place) == F.col("_text"), "left").drop("_text")


def tag_places(relations: DataFrame, place: str, state_codes: DataFrame, places: Places) -> DataFrame:
    """relations with country_code and subdiv_code by the batch rules, the first that matches winning.

    State code, Delaware, US state name, country name (but for Georgia), alias, "City, ST", Canadian province, and the last part of
    "x, y" as a country. state_codes has (code, country_code, subdiv_code).
    """
    d = relations.withColumn("_k", _key(place)).withColumn("_last", _key(F.substring_index(F.col(place), ",", -1)))
    d = d.withColumn("_city", F.when(F.col(place).rlike(", [A-Za-z]{2}$"), F.lower(F.substring(F.col(place), -2, 2))))
    codes = small(_first(state_codes.select(_key("code").alias("k"), F.col("country_code").alias("cc"), F.col("subdiv_code").alias("sc")), ["k"], "cc", "sc"))
    for c, out in (("_k", "_a"), ("_city", "_e")):
        d = d.join(codes.select(F.col("k").alias(f"{c}_code"), F.struct("cc", "sc").alias(out)), F.col(c) == F.col(f"{c}_code"), "left")
    for c in ("_k", "_last"):
        d = d.join(places.meanings.withColumnsRenamed({"k": f"{c}_key", "m": f"{c}_m"}), F.col(c) == F.col(f"{c}_key"), "left")
    own, last = F.col("_k_m"), F.col("_last_m")
    d = d.withColumns({"_b": own["us"], "_c": own["country"], "_d": own["alias"], "_f": F.when(own["any_name"]["cc"] == "CA", own["any_name"]), "_g": last["country"]})
    pair = lambda x: F.when(F.col(x).isNotNull(), F.struct(F.col(f"{x}.cc").alias("cc"), F.lit(None).cast("string").alias("sc")))
    delaware = F.when(F.col("_k").contains("delaware"), F.struct(F.lit("US").alias("cc"), F.lit("DE").alias("sc")))
    hit = F.coalesce("_a", delaware, "_b", F.when(F.col("_k") != "georgia", pair("_c")), "_d", "_e", "_f", pair("_g"))
    return d.withColumn("_hit", hit).select(*relations.columns, F.col("_hit.cc").alias("country_code"), F.col("_hit.sc").alias("subdiv_code"))


def best_locations(locations: DataFrame, years: DataFrame) -> DataFrame:
    """(cw_id, year, location_id): of the places valid in a year, the best kind's latest.

    Business before mailing address, then a relation's place with a subdivision, any relation's place, the state of incorporation.
    locations: location_id, cw_id, type, subdiv_code, min_year, max_year; years: year.
    """
    valid = locations.join(small(years), F.col("year").between(F.col("min_year"), F.col("max_year")))
    of = lambda c: F.max(F.when(c, F.col("location_id")))
    kind = F.col("type")
    picks = [of(kind == "business"), of(kind == "mailing"), of((kind == "relation_loc") & F.col("subdiv_code").isNotNull()), of(kind == "relation_loc"), of(kind == "state_of_incorp")]
    return valid.groupBy("cw_id", "year").agg(F.coalesce(*picks).alias("location_id"))


def fill_locations(info: DataFrame, locations: DataFrame, null_location_id: int | None = None) -> DataFrame:
    """info (cw_id, year, location_id) whose missing place, or place without a country, is any of the company's places that has one.

    Companies without any place get null_location_id, the shared row that stands for no place.
    """
    coded = locations.filter("country_code is not null")
    any_ = coded.groupBy("cw_id").agg(F.max("location_id").alias("_any"))
    has = coded.select(F.col("location_id").alias("_loc"), F.lit(True).alias("_coded"))
    out = info.join(any_, "cw_id", "left").join(has, F.col("location_id") == F.col("_loc"), "left")
    out = out.withColumn("location_id", F.when(F.col("_coded"), F.col("location_id")).otherwise(F.coalesce("_any", "location_id", F.lit(null_location_id))))
    return out.select(info.columns)
