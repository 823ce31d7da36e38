"""Column functions on file paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def glob_regex(glob: str) -> str:
    """An anchored regular expression for a glob on full paths: ** crosses directories, * and ? don't."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        if glob.startswith("**", i):
            out, i = out + ".*", i + 1
        elif c == "*":
            out += "[^/]*"
        elif c == "?":
            out += "[^/]"
        elif c == "[" and (end := glob.find("]", i + 2)) > 0:
            body = glob[i + 1 : end]
            out, i = out + "[" + ("^" + body[1:] if body[0] in "!^" else body).replace("\\", "\\\\") + "]", end
        else:
            out += re.escape(c)
        i += 1
    return f"^{out}$"


def literal_root(glob: str) -> str:
    """The directory in front of a glob's first wildcard: where a listing has to start."""
    literal = re.split(r"[*?\[]", glob, maxsplit=1)[0]
    return literal if literal == glob else literal.rpartition("/")[0] + "/"


def without_scheme(path: Column) -> Column:
    """A path without ``file:`` and surplus slashes in front, as listings give it."""
    return F.regexp_replace(path, "^file:/+", "/")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def file_stem(path: Column) -> Column:
    """The file name up to its first dot."""
    return F.split_part(file_name(path), F.lit("."), F.lit(1))


def dir_name(path: Column) -> Column:
    """The name of the directory that a file is in, null at the top."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def normal(path: Column) -> Column:
    """A path without doubled or trailing slashes."""
    return F.regexp_replace(F.regexp_replace(path, "/+", "/"), "(?<=.)/$", "")


def remove_suffix(path: Column, suffix: str | Column) -> Column:
    """The path without the suffix if it ends with it; an empty suffix changes nothing."""
    s = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.when(F.endswith(path, s), F.left(path, F.length(path) - F.length(s))).otherwise(path)


def remove_suffix_pattern(path: Column, pattern: str) -> Column:
    """The path without the text of the pattern's first match, if the path also ends with that text."""
    return remove_suffix(path, F.regexp_extract(path, pattern, 0))


def move(path: Column, source: str, target: str) -> Column:
    """The path under ``target`` as it was under ``source``; raises for a path outside of ``source``."""
    clean, root = normal(path), re.sub("/+", "/", source).rstrip("/")
    inside = F.startswith(clean, F.lit(root + "/"))
    moved = F.concat(F.lit(target.rstrip("/") + "/"), F.substr(clean, F.lit(len(root) + 2)))
    return F.when(inside, moved).otherwise(F.raise_error(F.concat(F.lit(f"not in {source}: "), path)).cast("string"))


def wds_id(path: Column) -> Column:
    """Parent directory and file name up to the first dot."""
    return F.concat(parent(path), F.lit("/"), file_stem(path))


def wds_ext(path: Column) -> Column:
    """The file name behind its first dot."""
    return F.regexp_extract(file_name(path), r"^[^.]*\.(.*)$", 1)


def increment_index(path: Column, by: int = 4) -> Column:
    """Adds to the first ``.digits.`` of the file name; unchanged without one."""
    name = file_name(path)
    digits = F.regexp_extract(name, r"\.(\d+)\.", 1)
    head, tail = F.regexp_extract(name, r"^(.*?\.)\d+\.", 1), F.regexp_extract(name, r"^.*?\.\d+(\..*)$", 1)
    new = F.concat(F.left(path, F.length(path) - F.length(name)), head, (digits.cast("bigint") + by).cast("string"), tail)
    return F.when(digits != "", new).otherwise(path)


def uri_parts(uri: Column) -> tuple[Column, Column]:
    """Bucket and key of scheme://bucket/key."""
    return F.regexp_extract(uri, r"^[a-z0-9]+://([^/]*)", 1), F.regexp_extract(uri, r"^[a-z0-9]+://[^/]*/(.*)$", 1)


def shard_path(path: Column, source: str, target: str, shard: Column, first: int = 0) -> Column:
    """target/shard-NNNN/relative path, with ``.source`` in front of the last extension."""
    relative = F.substr(path, F.lit(len(source.rstrip("/")) + 2))
    named = F.regexp_replace(relative, r"(\.[^./]+)$", ".source$1")
    return F.concat(F.lit(target.rstrip("/") + "/"), F.format_string("shard-%04d/", (shard + first).cast("int")), named)


def output_path(path: Column, suffix: str, new_suffix: str) -> Column:
    return F.concat(remove_suffix(path, suffix), F.lit(new_suffix))
