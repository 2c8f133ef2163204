"""S3-compatible object store settings.

Configuration only: Spark reaches an S3-compatible store through the
``s3a://`` Hadoop connector, which must be on the classpath
(``hadoop-aws``). Pass the result to ``build_session(extra=...)``.
"""

from __future__ import annotations


def s3a_settings(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = False,
) -> dict[str, str]:
    """Session settings for an S3-compatible endpoint (path-style, no SSL by default)."""
    # The property names of the public s3a connector.
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def object_path(bucket: str, key: str, scheme: str = "s3a") -> str:
    """``s3a://bucket/key``, the path Spark readers and writers take."""
    return f"{scheme}://{bucket}/{key.lstrip('/')}"
