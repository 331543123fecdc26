"""Files of any store Spark names by URI, opened by tasks that need only a part of them."""

from __future__ import annotations

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI as Spark lists it, and the path inside.

    Paths without a scheme, and ``file:`` with any number of slashes, are local. Names are taken as they are: Spark does not
    encode blanks and the like.
    """
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon and scheme == "file" else uri).lstrip("/")
    authority, _, key = rest.removeprefix("//").partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return store, f"{base.rstrip('/')}/{key}"
