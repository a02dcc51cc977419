"""Paths and addresses of files."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def normalise_path(p: Column, relative: bool = False) -> Column:
    """Backslashes to slashes; ``/`` or null to empty.

    ``relative=True`` drops one leading slash.
    """
    slashed = F.replace(p, F.lit("\\"), F.lit("/"))
    if relative:
        slashed = F.when(slashed.startswith("/"), F.substring(slashed, 2, 2_147_483_647)).otherwise(slashed)
    return F.when(p.isNull() | (slashed == "/"), F.lit("")).otherwise(slashed)


def _tidy(p: Column) -> Column:
    single = F.regexp_replace(p, "/{2,}", "/")
    return F.when(F.length(single) > 1, F.regexp_replace(single, "/$", "")).otherwise(single)


def join_path(directory: Column, name: Column) -> Column:
    """Directory plus name with single separators; a blank directory gives the name alone."""
    blank = F.coalesce(directory.rlike(r"\A\p{javaWhitespace}*\z"), F.lit(True))
    return F.when(blank, name).otherwise(_tidy(F.concat(directory, F.lit("/"), name)))


def parent(p: Column) -> Column:
    """Directory part of a path: null when there is none, ``/`` for a file in the root."""
    cut = F.length(p) - F.length(F.substring_index(p, "/", -1))
    return (F.when(~F.contains(p, F.lit("/")), F.lit(None).cast("string"))
            .when(cut == 1, F.lit("/"))
            .otherwise(F.substring(p, F.lit(1), cut - 1)))


def depth(directory: Column) -> Column:
    """Number of path parts; 0 for the empty path."""
    return F.when(directory == "", 0).otherwise(
        F.length(directory) - F.length(F.replace(directory, F.lit("/"), F.lit(""))) + 1)


def ancestors(directory: Column) -> Column:
    """The directory and all directories above it, shallow first."""
    parts = F.split(directory, "/")
    chain = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    chain = F.transform(chain, lambda d: F.when(d == "", F.lit("/")).otherwise(d))
    return F.when(directory.isNull() | (directory == ""), F.array().cast("array<string>")) \
            .when(directory == "/", F.array(F.lit("/"))) \
            .otherwise(chain)


def relative_dir(directory: Column, base: Column | str) -> Column:
    """Drop a literal base prefix and one following slash."""
    base = F.lit(base) if isinstance(base, str) else base
    rest = F.substring(directory, F.length(base) + 1, F.length(directory))
    rest = F.when(rest.startswith("/"), F.substring(rest, 2, 2_147_483_647)).otherwise(rest)
    return F.when(F.startswith(directory, base), rest).otherwise(directory)


def service_uri(host: Column, port: Column, share: Column) -> Column:
    return F.concat(F.lit("smb://"), host, F.lit(":"), port.cast("string"), F.lit("/"), share)


def display_path(service: Column, directory: Column) -> Column:
    """``service/`` or ``service/directory/``, as shown for a listing."""
    d = normalise_path(directory)
    return F.concat(service, F.lit("/"), F.when(d == "", F.lit("")).otherwise(F.concat(d, F.lit("/"))))


# Characters that a URI path may hold unescaped (ASCII part).
_PATH_SAFE = r"A-Za-z0-9_\-!.~'()*,;:$&+=/@"


def _escape_path(p: Column) -> Column:
    unsafe = rf"[\x00-\x7F\p{{Cc}}\p{{Z}}&&[^{_PATH_SAFE}]]"

    def escape(ch: Column) -> Column:
        code = F.replace(F.url_encode(ch), F.lit("+"), F.lit("%20"))
        return F.when(ch.rlike(unsafe), code).otherwise(ch)

    return F.when(p.rlike(unsafe), F.array_join(F.transform(F.split(p, ""), escape), "")).otherwise(p)


def transit_uri(service: Column, path: Column) -> Column:
    """Full address of a file: one separator, unsafe characters escaped."""
    p = normalise_path(path, relative=True)
    sep = F.when(service.endswith("/") | (p == ""), F.lit("")).otherwise(F.lit("/"))
    return F.concat(service, sep, _escape_path(p))
