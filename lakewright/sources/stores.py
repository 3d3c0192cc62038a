"""File systems for objects that tasks open themselves, with the settings that Spark's own readers use.

Spark reads object stores through Hadoop, whose settings live in the JVM; Python tasks open objects through Arrow. What the session's
Hadoop configuration says about S3, for all buckets and for single ones, is taken at planning and sent along with the task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession

#: Of the settings below ``fs.s3a.`` or ``fs.s3a.bucket.<name>.``, those that have a counterpart in Arrow or decide who reads.
S3A_KEYS = (
    "access.key",
    "secret.key",
    "session.token",
    "aws.credentials.provider",
    "assumed.role.arn",
    "assumed.role.session.name",
    "endpoint",
    "endpoint.region",
    "connection.ssl.enabled",
    "path.style.access",
    "proxy.host",
    "proxy.port",
    "proxy.username",
    "proxy.password",
    "requester.pays.enabled",
)
_S3A, _BUCKET = "fs.s3a.", "fs.s3a.bucket."
_CENTRAL = "s3.amazonaws.com"  # Hadoop's default; with it the region chooses the host

Settings = Mapping[str, str]


def store_settings(spark: SparkSession) -> dict[str, str]:
    """The session's S3 settings by their full names, per-bucket ones included; what is unset or empty is left out."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found = {}
    for entry in conf.getPropsWithPrefix(_S3A).entrySet().toArray():
        name = entry.getKey()
        if name in S3A_KEYS or name.startswith("bucket.") and name.endswith(tuple(f".{key}" for key in S3A_KEYS)):
            value = conf.get(_S3A + name) or ""  # with variables filled in
            if value.strip():
                found[_S3A + name] = value.strip()
    return found


def _of(settings: Settings, bucket: str, key: str) -> str | None:
    """A bucket's own setting, else the one for all buckets."""
    return settings.get(f"{_BUCKET}{bucket}.{key}", settings.get(_S3A + key))


def _is(settings: Settings, bucket: str, key: str) -> bool:
    return (_of(settings, bucket, key) or "").lower() == "true"


def s3_arguments(settings: Settings, bucket: str) -> dict[str, Any]:
    """Arguments of Arrow's ``S3FileSystem`` for one bucket; without settings Arrow finds credentials and region by itself."""
    out: dict[str, Any] = {}
    provider = _of(settings, bucket, "aws.credentials.provider") or ""
    role = _of(settings, bucket, "assumed.role.arn")
    key, secret = _of(settings, bucket, "access.key"), _of(settings, bucket, "secret.key")
    if "AnonymousAWSCredentialsProvider" in provider:
        out["anonymous"] = True
    elif role and "AssumedRoleCredentialProvider" in provider:
        out |= {"role_arn": role, "session_name": _of(settings, bucket, "assumed.role.session.name")}
    elif key and secret:
        out |= {"access_key": key, "secret_key": secret, "session_token": _of(settings, bucket, "session.token")}
    out["region"] = _of(settings, bucket, "endpoint.region")
    endpoint = _of(settings, bucket, "endpoint") or ""
    scheme, host = re.match(r"(?:(https?)://)?(.*?)/*$", endpoint).groups()
    if host and host != _CENTRAL:
        out["endpoint_override"] = host
        out["force_virtual_addressing"] = not _is(settings, bucket, "path.style.access")
    secure = _of(settings, bucket, "connection.ssl.enabled")
    if scheme or secure:
        out["scheme"] = scheme or ("https" if secure.lower() == "true" else "http")
    proxy = _of(settings, bucket, "proxy.host")
    if proxy:
        user = {"username": _of(settings, bucket, "proxy.username"), "password": _of(settings, bucket, "proxy.password")}
        port = int(_of(settings, bucket, "proxy.port") or 443)
        out["proxy_options"] = {"scheme": "http", "host": proxy, "port": port} | {k: v for k, v in user.items() if v}
    return {k: v for k, v in out.items() if v is not None}


def _parts(path: str) -> tuple[str | None, str, str]:
    """Scheme, store and name of a path; a local path has neither scheme nor store."""
    scheme, rest = re.match(r"(?:([a-z][a-z0-9+.-]*):)?(.*)", path, re.S).groups()
    if scheme in (None, "file"):
        return None, "", re.sub("^//+", "/", rest)
    return scheme, *re.match("//([^/]*)/?(.*)", rest, re.S).groups()


def tasks_can_open(path: str, settings: Settings) -> bool:
    """Whether tasks can open objects of this store themselves: Arrow cannot ask for objects that the requester pays."""
    scheme, store, _ = _parts(path)
    return scheme not in ("s3", "s3a") or not _is(settings, store, "requester.pays.enabled")


def store_of(path: str, settings: Settings | None = None) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a path and the path within it, both taken as they are: Spark's paths are not URI-encoded."""
    scheme, store, name = _parts(path)
    if scheme is None:
        return pafs.LocalFileSystem(), name
    if scheme in ("s3", "s3a"):
        if not tasks_can_open(path, settings or {}):
            raise PermissionError(f"the requester pays for {scheme}://{store}; only Spark's own readers open it")
        return pafs.S3FileSystem(**s3_arguments(settings or {}, store)), f"{store}/{name}"
    return pafs.FileSystem.from_uri(f"{scheme}://{store}/")[0], f"/{name}"


def open_object(path: str, settings: Settings | None = None) -> pa.NativeFile:
    """A seekable stream over one object."""
    store, name = store_of(path, settings)
    return store.open_input_file(name)
