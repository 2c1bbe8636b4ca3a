"""Byte streams of files, opened inside tasks."""

from __future__ import annotations

from urllib.parse import quote

CHUNK = 1024 * 1024

#: Names that Hadoop gives to stores which pyarrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def stream_uri(path: str) -> str:
    """``path`` in the form pyarrow opens: its scheme names, and three slashes for local files."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return path.replace("file:/", "file:///", 1)
    scheme, mark, rest = path.partition("://")
    return f"{SCHEMES.get(scheme, scheme)}://{rest}" if mark else path


def open_stream(path: str):
    """Input stream of a file by path or URI."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(quote(stream_uri(path), safe="/:@"))
    return system.open_input_stream(inner)


def chunks_of(path: str):
    with open_stream(path) as stream:
        while chunk := stream.read(CHUNK):
            yield chunk


def head_of(path: str, encoding: str) -> str:
    """First line of a text file, which is read no further."""
    import codecs

    decoder = codecs.getincrementaldecoder(encoding)("ignore")
    parts = []
    for chunk in chunks_of(path):
        text = decoder.decode(chunk)
        parts.append(text)
        if "\n" in text:
            break
    return "".join(parts).removeprefix("\ufeff").split("\n")[0].rstrip("\r")
