"""Driver-side helpers: dataset roots, commands of outside tools, the search for their runtimes."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from pathlib import PurePosixPath


def dataset_root(train_csv: str, eval_csv: str, first_audio: str | None = None) -> tuple[str, str, str]:
    """(root, train, eval): the folder that holds a databases folder, else that of the table, widened to the audio.

    >>> dataset_root("/s/databases/train.csv", "/s/databases/eval.csv", "/s/audio/1.wav")
    ('/s', 'databases/train.csv', 'databases/eval.csv')
    """
    folder = PurePosixPath(train_csv).parent
    root = folder.parent if folder.name == "databases" else folder
    if first_audio:
        root = PurePosixPath(os.path.commonpath([str(root), str(PurePosixPath(first_audio).parent)]))
    return str(root), os.path.relpath(train_csv, root), os.path.relpath(eval_csv, root)


def command(program: list[str], options: Mapping[str, object]) -> list[str]:
    """An argument vector: None and False leave an option out, True gives it alone.

    >>> command(["align"], {"--language": "eng", "--model": None, "--romanize": True})
    ['align', '--language', 'eng', '--romanize']
    """
    out = list(program)
    for name, value in options.items():
        if value is True:
            out.append(name)
        elif value is not None and value is not False:
            out += [name, str(value)]
    return out


def first_found(candidates: list[str | None], exists: Callable[[str], bool] = os.path.exists) -> str | None:
    """The first candidate that is set and exists: explicit, then environment, then layout."""
    return next((c for c in candidates if c and exists(c)), None)
