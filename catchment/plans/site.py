"""Inventory of a reporting site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.operators import lookup


def workbook_details(workbooks: DataFrame, views: DataFrame, connections: DataFrame) -> DataFrame:
    """Workbooks with their view names and connection ids (or types), each as one text."""
    shown = lookup.joined_names(views, "workbook_id", "name", "views")
    target = F.coalesce(F.nullif(F.col("datasource_id"), F.lit("")), F.col("connection_type"))
    used = lookup.joined_names(connections.withColumn("_target", target), "workbook_id", "_target", "connections")
    return (
        workbooks.withColumnRenamed("id", "workbook_id")
        .join(shown, "workbook_id", "left")
        .join(used, "workbook_id", "left")
        .select(
            "workbook_id",
            F.col("name").alias("workbook_name"),
            "project_id",
            "owner_id",
            *[c for c in ("created_at", "updated_at") if c in workbooks.columns],
            F.coalesce("connections", F.lit("")).alias("connections"),
            F.coalesce("views", F.lit("")).alias("views"),
        )
    )


def site_inventory(
    users: DataFrame,
    groups: DataFrame,
    members: DataFrame,
    projects: DataFrame,
    workbooks: DataFrame,
    datasources: DataFrame,
    views: DataFrame,
    connections: DataFrame,
) -> dict[str, DataFrame]:
    return {
        "users": lookup.user_directory(users, members, groups),
        "active_users": lookup.user_directory(lookup.active_users(users), members, groups),
        "dashboards": lookup.per_project(projects, workbooks, "dashboard_name"),
        "datasources": lookup.per_project(projects, datasources, "datasource_name"),
        "workbooks": workbook_details(workbooks, views, connections),
    }
