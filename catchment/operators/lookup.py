"""Equi joins with the null and ordering rules of the directory and the site inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.operators.skew import spread_hot_keys

# Column order of the routing directory.
DIRECTORY_COLUMNS = [
    "routing_number",
    "bank_name",
    "address_full",
    "phone",
    "office_type",
    "telegraphic_name",
    "location",
    "funds_transfer_status",
    "book_entry_securities_transfer_status",
    "servicing_fed_main_office_rtn",
    "servicing_fed_main_office_addr",
    "status",
    "change_date",
    "revision_date",
    "source_url_ach",
    "source_url_wire",
    "scraped_at_ach",
    "scraped_at_wire",
]


def routing_directory(ach: DataFrame, wire: DataFrame, key: str = "routing_number") -> DataFrame:
    """Full outer join; shared columns get a suffix, except the name, which is the first one present."""
    shared = [c for c in ach.columns if c in wire.columns and c != key]
    left = ach.withColumnsRenamed({c: f"{c}_ach" for c in shared})
    right = wire.withColumnsRenamed({c: f"{c}_wire" for c in shared})
    joined = left.join(right, key, "full")
    if "bank_name" in shared:
        joined = joined.withColumn("bank_name", F.coalesce("bank_name_ach", "bank_name_wire")).drop(
            "bank_name_ach", "bank_name_wire"
        )
    known = [c for c in DIRECTORY_COLUMNS if c in joined.columns]
    return joined.select(*known, *[c for c in joined.columns if c not in known])


def only_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key), key, "left_anti")


def per_project(projects: DataFrame, items: DataFrame, item_column: str, project: str | None = None) -> DataFrame:
    """Each project's items by name; a project without any keeps one row with null.

    An inner join and the projects it leaves over: an outer join could not split, nor broadcast past,
    one project that holds much of all items.
    """
    chosen = projects if project is None else projects.filter(F.col("name") == project)
    named = items.select("project_id", F.col("name").alias(item_column))
    kept = chosen.select(F.col("id").alias("project_id"), F.col("name").alias("project_name"))
    filled = named.join(kept, "project_id").select("project_name", item_column)
    empty = kept.join(named.select("project_id").distinct(), "project_id", "left_anti")
    return filled.unionByName(empty.select("project_name", F.lit(None).cast("string").alias(item_column)))


def joined_names(df: DataFrame, key: str, name: str, out: str, separator: str = ", ") -> DataFrame:
    """Names per key as one text, in name order, repeats included.

    Repeats travel as a count: they are folded before the rows of a key meet, and written out at the end.
    """
    folded = df.filter(F.col(name).isNotNull()).groupBy(key, name).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    listed = folded.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(name, "_n"))).alias("_names"))
    repeated = F.flatten(F.transform("_names", lambda e: F.array_repeat(e[name], e["_n"])))
    return listed.select(key, F.array_join(repeated, separator).alias(out))


def user_groups(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Group names of every user that is in one. A group that holds much of all members is spread."""
    names = groups.select(F.col("id").alias("group_id"), F.col("name").alias("group_name"))
    many, few, keys = spread_hot_keys(members.select("group_id", "user_id"), names, ["group_id"], ["user_id"])
    return joined_names(many.join(few, keys), "user_id", "group_name", "group_memberships")


def user_directory(users: DataFrame, members: DataFrame, groups: DataFrame) -> DataFrame:
    """Users with their group names, empty text when in none; the name stands in for a missing e-mail."""
    listed = user_groups(members, groups)
    return users.join(listed, users["id"] == listed["user_id"], "left").select(
        F.col("name").alias("username"),
        F.col("fullname").alias("full_name"),
        F.coalesce(F.nullif(F.col("email"), F.lit("")), F.col("name")).alias("email"),
        "site_role",
        "auth_setting",
        *(["last_login"] if "last_login" in users.columns else []),
        F.coalesce("group_memberships", F.lit("")).alias("group_memberships"),
    )


def active_users(users: DataFrame) -> DataFrame:
    """A role that is present and is not ``unlicensed``."""
    return users.filter((F.col("site_role") != "") & (F.lower("site_role") != "unlicensed"))


def group_id_of(groups: DataFrame, name: str) -> object:
    """Id of the first group with this name; an unknown name raises."""
    row = groups.filter(F.col("name") == name).orderBy("id").select("id").first()
    if row is None:
        raise ValueError(f"group {name!r} not found")
    return row["id"]


def users_in_group(users: DataFrame, members: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    chosen = members.filter(F.col("group_id") == group_id_of(groups, name))
    return users.join(chosen, users["id"] == chosen["user_id"], "left_semi")


def workbooks_using(workbooks: DataFrame, connections: DataFrame, datasource_id: str) -> DataFrame:
    """Each workbook once, however many of its connections lead there."""
    used = connections.filter(F.col("datasource_id") == datasource_id)
    return workbooks.join(used, workbooks["id"] == used["workbook_id"], "left_semi")


def membership_plan(requests: DataFrame, users: DataFrame, members: DataFrame, groups: DataFrame) -> DataFrame:
    """What adding each (user_email, group_name) request would do.

    Users match on the lower-cased name. ``user_action`` is added or existing, ``group_action`` is
    added or already; a group that does not exist gives an error text instead.
    """
    known = users.select(F.lower("name").alias("_name"), F.col("id").alias("_user_id")).groupBy("_name").agg(
        F.min("_user_id").alias("_user_id")
    )
    named = groups.groupBy(F.col("name").alias("group_name")).agg(F.min("id").alias("_group_id"))
    in_group = members.select(
        F.col("group_id").alias("_in_group"), F.col("user_id").alias("_in_user")
    ).distinct()
    found = (
        requests.withColumn("_name", F.lower("user_email")).join(known, "_name", "left").join(named, "group_name", "left")
    )
    placed = found.join(
        in_group,
        (found["_group_id"] == in_group["_in_group"]) & (found["_user_id"] == in_group["_in_user"]),
        "left",
    )
    return placed.select(
        "user_email",
        "group_name",
        F.when(F.col("_user_id").isNull(), "added").otherwise("existing").alias("user_action"),
        F.when(F.col("_group_id").isNull(), None)
        .when(F.col("_in_user").isNull(), "added")
        .otherwise("already")
        .alias("group_action"),
        F.when(F.col("_group_id").isNull(), F.concat(F.lit("group "), "group_name", F.lit(" not found"))).alias("error"),
    )


def branch_minutes(branches: DataFrame, minutes: list[int]) -> DataFrame:
    """Every branch with every drive time and that time in seconds."""
    return branches.withColumn("time_frame_minutes", F.explode(F.array(*[F.lit(m) for m in minutes]))).withColumn(
        "seconds", F.col("time_frame_minutes") * 60
    )


def duration_pairs(matrix: DataFrame) -> DataFrame:
    """Source by destination rows of a duration matrix, null where the matrix is short."""

    def place(side: str, prefix: str) -> list:
        return [
            F.coalesce(F.col(f"{side}.name"), F.lit("Unknown")).alias(f"{prefix}_name"),
            F.get(F.col(f"{side}.location"), F.lit(0)).alias(f"{prefix}_longitude"),
            F.get(F.col(f"{side}.location"), F.lit(1)).alias(f"{prefix}_latitude"),
            F.col(f"{side}.distance").alias(f"{prefix}_distance"),
        ]

    return (
        matrix.select("destinations", "durations", F.posexplode("sources").alias("i", "s"))
        .select("durations", "i", "s", F.posexplode("destinations").alias("j", "d"))
        .select(
            *place("s", "source"),
            *place("d", "destination"),
            F.get(F.get(F.col("durations"), F.col("i")), F.col("j")).alias("duration"),
        )
    )
