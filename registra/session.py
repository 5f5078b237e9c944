"""Session settings: shared work folder and object-store connection."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# The connector that belongs to the Hadoop version Spark 4.1 is built with.
S3A_PACKAGE = "org.apache.hadoop:hadoop-aws:3.4.2"


def qualify(spark: SparkSession, path: str) -> str:
    """Give a path without a scheme the cluster's default file system."""
    if "://" in path or path.startswith("file:"):
        return path
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    default = spark.conf.get("spark.hadoop.fs.defaultFS", None) or hadoop.get("fs.defaultFS")
    return path if not default or default.startswith("file:") else default.rstrip("/") + path


def ship_package() -> None:
    """Send this package's code with each job, so that executors need no installation."""
    import registra

    cloudpickle.register_pickle_by_value(registra)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared folder, `spark.checkpoint.dir`.

    Only a session without that setting (a local test) gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="registra-")
    return f"{qualify(spark, shared).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def s3a_conf(environment: Mapping[str, str] | None = None) -> dict[str, str]:
    """`spark.hadoop.fs.s3a.*` settings for an S3-compatible store.

    Endpoint and keys come from the environment only. Without keys the connector's own
    credential chain applies, so a cluster role needs no secret at all.
    """
    env = os.environ if environment is None else environment
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }
    named = {
        "spark.hadoop.fs.s3a.endpoint": "AWS_ENDPOINT_URL",
        "spark.hadoop.fs.s3a.access.key": "AWS_ACCESS_KEY_ID",
        "spark.hadoop.fs.s3a.secret.key": "AWS_SECRET_ACCESS_KEY",
        "spark.hadoop.fs.s3a.endpoint.region": "AWS_REGION",
    }
    conf.update({key: env[var] for key, var in named.items() if env.get(var)})
    return conf


def store_options(environment: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of the archive source for the same store. Keys are left to the executors'
    own environment or role, so that none shows up in a query plan."""
    env = os.environ if environment is None else environment
    scheme, _, host = env.get("AWS_ENDPOINT_URL", "").rpartition("://")
    options = {"endpoint": host, "scheme": scheme, "region": env.get("AWS_REGION", "")}
    return {key: value for key, value in options.items() if value}


def object_store_builder(
    builder: SparkSession.Builder,
    environment: Mapping[str, str] | None = None,
    packages: str | None = None,
) -> SparkSession.Builder:
    """Apply :func:`s3a_conf` to a session builder; master and resources stay the caller's.

    `packages` names the connector to fetch, such as :data:`S3A_PACKAGE`, on clusters that
    do not have it installed.
    """
    conf = s3a_conf(environment)
    if packages:
        conf["spark.jars.packages"] = packages
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder
