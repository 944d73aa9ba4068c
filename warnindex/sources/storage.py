"""Opening and writing files by path inside tasks, so that only paths are shuffled."""

from __future__ import annotations


def _resolve(path: str):
    """File system and path of a local path or a URI (``file:``, ``hdfs://``, ``s3://``, ...)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def open_path(path: str):
    """A seekable binary file; compression by suffix is not undone."""
    f, p = _resolve(path)
    return open(p, "rb") if f.type_name == "local" else f.open_input_file(p)


def save_bytes(path: str, content: bytes) -> None:
    """Write a whole small file; a retried task overwrites it with the same bytes."""
    f, p = _resolve(path)
    f.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with f.open_output_stream(p, compression=None) as out:
        out.write(content)


def list_tree(directory: str) -> list[str]:
    """Every file below ``directory``, named the way it is (path or URI); one listing call."""
    from pyarrow import fs

    f, p = _resolve(directory)
    found = f.get_file_info(fs.FileSelector(p, recursive=True, allow_not_found=True))
    head = "file:" if directory.startswith("file:") else directory[: len(directory) - len(p)] if "://" in directory else ""
    return sorted(head + x.path for x in found if x.type == fs.FileType.File)
