"""Reshape a raw nested profile (one API response as JSON text) into the
flat user record.

The response is parsed once with `try_parse_json`, and the first result is
cast once into a struct whose leaves are typed `variant`.  A variant keeps
apart what `from_json` merges: a key that is missing gives a SQL NULL leaf,
a key present with JSON null gives a variant null.  Rules:

* unparsable text (including duplicate keys) -> `bad_json`
* no first result (`results` empty or absent) -> `no_result`
* any of the 15 leaves missing -> `missing_field`
* a leaf present but null: passes as null for gender, dob,
  registered_date, phone, picture; any other -> `null_field`
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.ids import derived_id
from tidewater.schemas import MESSAGE_KEYS

# --- fixed values: paths read from the first result ------------------------
FIRST = "$.results[0]"
ADDRESS_PATHS = (
    "location.street.number", "location.street.name", "location.city",
    "location.state", "location.country",
)
FIELD_PATHS = {
    "first_name": "name.first",
    "last_name": "name.last",
    "gender": "gender",
    "post_code": "location.postcode",
    "email": "email",
    "username": "login.username",
    "dob": "dob.date",
    "registered_date": "registered.date",
    "phone": "phone",
    "picture": "picture.medium",
}
NULLABLE = ("gender", "dob", "registered_date", "phone", "picture")
# ---------------------------------------------------------------------------


def _text(leaf: Column) -> Column:
    return F.try_variant_get(leaf, "$", "string")


def address(n: Column, s: Column, c: Column, st: Column, co: Column) -> Column:
    """"{number} {name}, {city}, {state}, {country}"; null if a part is."""
    return F.concat(n, F.lit(" "), s, F.lit(", "), c, F.lit(", "), st, F.lit(", "), co)


def _leaf_type(paths: Sequence[str]) -> str:
    """DDL of a struct holding every path, each leaf typed `variant` so
    that a missing key (SQL null) stays apart from a JSON null."""
    tree: dict = {}
    for p in paths:
        node = tree
        *parents, leaf = p.split(".")
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = None

    def ddl(node: dict) -> str:
        return "struct<" + ", ".join(
            f"`{k}`: " + ("variant" if v is None else ddl(v)) for k, v in node.items()
        ) + ">"

    return ddl(tree)


def reshape_profiles(raw: DataFrame, text_col: str, id_coords: Sequence) -> DataFrame:
    """Columns: the 12 message fields (`id` derived from `id_coords`) and
    `reject_reason` (null = accepted).  A first result, or a part of it, that is
    not an object where one is needed is rejected as `bad_shape`; a record of the
    wrong shape never fails the query.

    The text is parsed once; the first result is cast once into a struct of
    variant leaves; text, presence and null-ness all read that struct.
    """
    leaves = list(ADDRESS_PATHS) + list(FIELD_PATHS.values())
    parsed = raw.select(
        derived_id(*id_coords).alias("id"),
        F.try_parse_json(F.col(text_col)).alias("_v"),
    )
    v = F.col("_v")
    pulled = parsed.select(
        "id",
        v.isNull().alias("_bad"),
        F.try_variant_get(v, FIRST, _leaf_type(leaves)).alias("_r"),
        F.try_variant_get(v, FIRST, "variant").alias("_first"),
    )

    def leaf(path: str) -> Column:
        c = F.col("_r")
        for name in path.split("."):
            c = c[name]
        return c

    required = list(ADDRESS_PATHS) + [p for k, p in FIELD_PATHS.items() if k not in NULLABLE]
    missing = F.lit(False)
    for p in leaves:
        missing = missing | leaf(p).isNull()
    nulls = F.lit(False)
    for p in required:
        nulls = nulls | F.is_variant_null(leaf(p))
    reason = (
        F.when(F.col("_bad"), F.lit("bad_json"))
        .when(F.col("_first").isNull(), F.lit("no_result"))
        .when(F.col("_r").isNull(), F.lit("bad_shape"))
        .when(missing, F.lit("missing_field"))
        .when(nulls, F.lit("null_field"))
    )
    values = {k: _text(leaf(p)) for k, p in FIELD_PATHS.items()}
    values["address"] = address(*[_text(leaf(p)) for p in ADDRESS_PATHS])
    values["id"] = F.col("id")
    return pulled.select(
        *[values[k].alias(k) for k in MESSAGE_KEYS], reason.alias("reject_reason")
    )


def reshape_profiles_typed(raw: DataFrame, text_col: str, id_coords: Sequence) -> DataFrame:
    """`from_json` form: one typed parse, first result by `get(results, 0)`
    (null, not an error, on an empty list).  It cannot tell a missing key
    from a null one, so it only rejects unparsable or empty responses and
    null required fields."""
    from tidewater.schemas import RAW_PROFILE

    first = F.get(F.from_json(F.col(text_col), RAW_PROFILE)["results"], 0)
    r = F.col("_r")
    loc = r["location"]
    out = raw.select(derived_id(*id_coords).alias("id"), first.alias("_r")).select(
        "id",
        r["name"]["first"].alias("first_name"),
        r["name"]["last"].alias("last_name"),
        r["gender"].alias("gender"),
        F.concat(loc["street"]["number"], F.lit(" "), loc["street"]["name"], F.lit(", "),
                 loc["city"], F.lit(", "), loc["state"], F.lit(", "), loc["country"]).alias("address"),
        loc["postcode"].alias("post_code"),
        r["email"].alias("email"),
        r["login"]["username"].alias("username"),
        r["dob"]["date"].alias("dob"),
        r["registered"]["date"].alias("registered_date"),
        r["phone"].alias("phone"),
        r["picture"]["medium"].alias("picture"),
        r.isNull().alias("_none"),
    )
    bad_required = F.lit(False)
    for k in ("first_name", "last_name", "address", "post_code", "email", "username"):
        bad_required = bad_required | F.col(k).isNull()
    return out.select(
        *MESSAGE_KEYS,
        F.when(F.col("_none"), F.lit("no_result"))
        .when(bad_required, F.lit("null_field"))
        .alias("reject_reason"),
    )
