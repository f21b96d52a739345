"""Files by URI, on the driver and in tasks."""

from __future__ import annotations

import json
import re
from urllib.parse import quote

from pyarrow import fs


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a local path or a path as Spark prints it, and the path within."""
    if uri.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    scheme, _, place = uri.partition(":/")
    return fs.FileSystem.from_uri(f"{scheme}:/{quote(place, safe='/@:')}")


def beside(uri: str, path: str) -> str:
    """``path`` as a URI: without a scheme of its own it is on the file system of ``uri``."""
    place = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/]+(?=/)", uri)
    return place[0] + path if place and path.startswith("/") else path


def path_of(uri: str) -> str:
    """A URI or path without scheme and host."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "", uri)


def exists(uri: str) -> bool:
    """Whether there is a file or folder."""
    filesystem, path = open_uri(uri)
    return filesystem.get_file_info(path).type != fs.FileType.NotFound


def read_json(uri: str) -> object:
    filesystem, path = open_uri(uri)
    with filesystem.open_input_stream(path) as file:
        return json.loads(file.read())


def write_json(uri: str, value: object) -> None:
    """Write a small file at once: it has all its content or is not there."""
    filesystem, path = open_uri(uri)
    folder, _, name = path.rpartition("/")
    filesystem.create_dir(folder, recursive=True)
    partial = f"{folder}/.{name}.tmp"
    with filesystem.open_output_stream(partial) as out:
        out.write(json.dumps(value).encode())
    filesystem.move(partial, path)
