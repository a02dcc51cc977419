"""Attributes, errors, sizes, durations and timestamps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tidemark.schema import ATTRS, FAILURE, NOT_FOUND

# File-server status codes that mean "no such file or path".
MISSING_FILE_CODES = (0xC000000F, 0xC0000034, 0xC000003A)
# The one reported here for any file that is not there.
MISSING_FILE_CODE = MISSING_FILE_CODES[1]
# Fixed value: code reported when the error carries none.
UNKNOWN_ERROR_CODE = "-2"
# Fixed value: user name of the share client when none is configured.
DEFAULT_SHARE_USER = "Guest"


def _empty_map() -> Column:
    return F.create_map().cast(ATTRS)


def merge_attributes(trigger: Column, listing: Column) -> Column:
    """Union of two attribute maps in which the listing wins."""
    t, l = F.coalesce(trigger, _empty_map()), F.coalesce(listing, _empty_map())
    kept = F.map_filter(t, lambda k, _: ~F.map_contains_key(l, k))
    return F.map_concat(kept, l)


def classify_error(code: Column) -> Column:
    """``not found`` for the three missing-file codes, else ``failure``."""
    return F.when(code.try_cast("bigint").isin(*MISSING_FILE_CODES), F.lit(NOT_FOUND)).otherwise(F.lit(FAILURE))


def error_code_text(code: Column) -> Column:
    return F.coalesce(code.try_cast("bigint").cast("string"), F.lit(UNKNOWN_ERROR_CODE))


def parse_initial_timestamp(s: Column) -> Column:
    """Struct ``(ms, error)``: an ISO instant first, then epoch milliseconds."""
    iso = s.rlike(r"(?i)\A\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?(Z|[+-]\d\d:\d\d)\z")
    instant = F.when(iso, F.unix_millis(F.upper(s).try_cast("timestamp")))
    epoch = F.when(s.rlike(r"\A[+-]?[0-9]+\z"), s.try_cast("bigint"))
    ms = F.coalesce(instant, epoch)
    # Fixed value: wording of the error.
    error = F.format_string("'%s' is neither an epoch timestamp nor a UTC datetime.", s)
    return F.struct(ms.alias("ms"), F.when(ms.isNull() & s.isNotNull(), error).alias("error"))


def iso_seconds(ts: Column) -> Column:
    """ISO date and time, cut to whole seconds.  The session zone must be UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


# Attribute names per provider, with the inventory column or
# ``extra`` entry each one is filled from and how times are written.
_COMMON_SFTP = {
    "filename": "filename", "path": "directory", "file.owner": "extra.owner", "file.group": "extra.group",
    "file.permissions": "extra.permissions", "file.size": "size", "file.lastModifiedTime": "iso_offset",
    "sftp.remote.host": "container", "sftp.remote.port": "extra.port", "sftp.listing.user": "extra.user",
}
_SMB = {
    "filename": "filename", "shortName": "extra.shortName", "path": "directory",
    "serviceLocation": "container", "lastModifiedTime": "iso",
    "creationTime": "extra.creationTime", "lastAccessTime": "extra.lastAccessTime",
    "changeTime": "extra.changeTime", "size": "size", "allocationSize": "extra.allocationSize",
}
_S3 = {
    "filename": "full_path", "s3.bucket": "container", "s3.region": "extra.region", "s3.etag": "etag",
    "s3.isLatest": "extra.isLatest", "s3.lastModified": "millis", "s3.length": "size",
    "s3.storeClass": "extra.storeClass", "s3.version": "extra.version",
}
_ADLS = {
    "azure.filesystem": "container", "azure.filePath": "full_path", "azure.directory": "directory",
    "azure.filename": "filename", "azure.length": "size", "azure.lastModified": "millis",
    "azure.etag": "etag",
}
ATTRIBUTE_NAMES = {"sftp": _COMMON_SFTP, "smb": _SMB, "s3": _S3, "adls": _ADLS}


def _attribute_source(source: str) -> Column:
    if source == "iso":
        return iso_seconds(F.col("last_modified"))
    if source == "iso_offset":
        return F.concat(iso_seconds(F.col("last_modified")), F.lit("+0000"))
    if source == "millis":
        return F.unix_millis("last_modified").cast("string")
    if source.startswith("extra."):
        return F.col("extra")[source.removeprefix("extra.")]
    return F.col(source).cast("string")


def to_attributes(provider: str) -> Column:
    """String map for an inventory row; entries without a value are left out.

    S3 keeps its object tags and user metadata, which sit in ``extra`` under
    their final attribute names.
    """
    pairs = ATTRIBUTE_NAMES[provider]
    args = [c for name, source in pairs.items() for c in (F.lit(name), _attribute_source(source))]
    attrs = F.map_filter(F.create_map(*args), lambda _, v: v.isNotNull())
    if provider == "s3":
        tags = F.map_filter(
            F.coalesce(F.col("extra"), _empty_map()),
            lambda k, _: k.startswith("s3.tag.") | k.startswith("s3.user.metadata."))
        attrs = F.map_concat(attrs, tags)
    return attrs


# Bytes per unit, and milliseconds per unit.
SIZE_UNITS = {"B": 1, "KB": 1024, "MB": 1024 ** 2, "GB": 1024 ** 3, "TB": 1024 ** 4}
DURATION_UNITS = {
    ("ns", "nano", "nanos", "nanosecond", "nanoseconds"): 1e-6,
    ("ms", "milli", "millis", "millisecond", "milliseconds"): 1,
    ("s", "sec", "secs", "second", "seconds"): 1_000,
    ("m", "min", "mins", "minute", "minutes"): 60_000,
    ("h", "hr", "hrs", "hour", "hours"): 3_600_000,
    ("d", "day", "days"): 86_400_000,
    ("w", "wk", "wks", "week", "weeks"): 604_800_000,
}

_QUANTITY = r"\A\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]+)\s*\z"


def _quantity(s: Column, units: list[tuple[str, float]]) -> Column:
    number = F.regexp_extract(s, _QUANTITY, 1).try_cast("double")
    unit = F.lower(F.regexp_extract(s, _QUANTITY, 2))
    first, *rest = units
    factor = reduce(lambda acc, u: acc.when(unit == u[0], F.lit(float(u[1]))), rest,
                    F.when(unit == first[0], F.lit(float(first[1]))))
    return number * factor


def parse_size(s: Column) -> Column:
    """``"10 MB"`` to bytes (double, as fractions of a byte can be asked for); null if malformed."""
    return _quantity(s, [(name.lower(), factor) for name, factor in SIZE_UNITS.items()])


def parse_duration(s: Column) -> Column:
    """``"5 secs"`` to whole milliseconds; null if malformed."""
    units = [(name, factor) for names, factor in DURATION_UNITS.items() for name in names]
    return _quantity(s, units).try_cast("bigint")


def root_cause(causes: Column, deepest: bool = True) -> Column:
    """Struct ``(class, message)`` to report for a chain of causes, outermost first.

    ``deepest`` takes the last cause and falls back to the outer message when
    that one has none (file shares); otherwise the outer error is reported.
    """
    outer = F.try_element_at(causes, F.lit(1))
    if not deepest:
        return F.struct(outer["class"].alias("class"), outer["message"].alias("message"))
    inner = F.try_element_at(causes, F.lit(-1))
    return F.struct(inner["class"].alias("class"), F.coalesce(inner["message"], outer["message"]).alias("message"))


def auth_mode(kind: str, has_user: Column, has_password: Column, has_key: Column | None = None) -> Column:
    """Which credential a row uses.  Takes presence flags only, never secrets.

    ``sftp``: password, key, both or none.  ``share``: password (possibly
    empty) as soon as there is a user, else anonymous.  ``put``: password when
    user and password are both there, else anonymous.
    """
    if kind == "sftp":
        return (F.when(has_password & has_key, "both").when(has_password, "password")
                .when(has_key, "key").otherwise("none"))
    if kind == "share":
        return F.when(has_user, "password").otherwise("anonymous")
    if kind == "put":
        return F.when(has_user & has_password, "password").otherwise("anonymous")
    raise ValueError(f"unknown kind {kind!r}")


# Attributes that name the target of a listing on error and empty rows.
TARGET_NAMES = {
    "sftp": ("sftp.remote.host", "sftp.remote.port", "sftp.listing.user"),
    "smb": ("smb.service.location", "smb.listing.directory"),
    "s3": ("s3.bucket", "s3.prefix"),
    "adls": ("azure.filesystem", "azure.directory"),
}


def target_attributes(kind: str, *values: Column) -> Column:
    """Map of the resolved target of a listing; a null S3 prefix is left out."""
    names = TARGET_NAMES[kind]
    if len(names) != len(values):
        raise ValueError(f"{kind} takes {len(names)} values")
    attrs = F.create_map(*[c for n, v in zip(names, values) for c in (F.lit(n), v.cast("string"))])
    if kind == "s3":
        attrs = F.map_filter(attrs, lambda k, v: (k != "s3.prefix") | v.isNotNull())
    return attrs


def error_attributes(message: Column, error_class: Column) -> Column:
    return F.create_map(F.lit("error.message"), message, F.lit("error.class"), error_class)
