"""Port and serving tables from a database. Needs the database's JDBC driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the database takes points apart on its own side, latitude from Y, longitude from X.
PORTS_QUERY = (
    "SELECT port_id, port_name, ST_Y(geom) AS port_lat, ST_X(geom) AS port_lon, radius_nm FROM port_reference"
)


def jdbc_query(spark: SparkSession, url: str, query: str, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) t").options(**properties).load()


def jdbc_ports(spark: SparkSession, url: str, properties: Mapping[str, str]) -> DataFrame:
    return jdbc_query(spark, url, PORTS_QUERY, properties)
