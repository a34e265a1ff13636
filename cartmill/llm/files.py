"""Files that tasks write and read themselves, in the shared folder, through pyarrow's file systems."""

from __future__ import annotations

import re

from pyarrow import fs


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or a URI (file, hdfs, s3, gs)."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def attempt_name() -> str:
    """A name no other attempt of any task of this job has."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return f"{context.stageId()}-{context.partitionId()}-{context.taskAttemptId()}"


def write_file(folder: str, name: str, parts: list[bytes]) -> None:
    """Write a file under a temporary name and move it in place, so that no reader sees half of it."""
    system, root = open_folder(folder)
    path = f"{root}/{name}"
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(f"{path}.tmp") as out:
        for part in parts:
            out.write(part)
    system.move(f"{path}.tmp", path)


def move_file(folder: str, source: str, target: str) -> None:
    """Move a file; a move done by an earlier attempt counts."""
    system, root = open_folder(folder)
    if system.get_file_info(f"{root}/{source}").type == fs.FileType.File:
        system.create_dir(f"{root}/{target}".rpartition("/")[0], recursive=True)
        system.move(f"{root}/{source}", f"{root}/{target}")
    elif system.get_file_info(f"{root}/{target}").type != fs.FileType.File:
        raise FileNotFoundError(f"neither {source} nor {target} is in {folder}")


def read_stream(folder: str, name: str):
    system, root = open_folder(folder)
    return system.open_input_file(f"{root}/{name}")
