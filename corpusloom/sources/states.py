"""Small numbered states of a growing table: the last one counts, so a writer that is lost leaves the one before."""

from __future__ import annotations

import json

from pyarrow import fs as pafs

from corpusloom.sources.commit import opened


def _listed(root: str) -> list[str]:
    fs, base = opened(root)
    return sorted(x.base_name for x in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if x.is_file and x.base_name.startswith("state-"))


def _read(root: str, name: str) -> dict:
    fs, base = opened(root)
    with fs.open_input_stream(f"{base}/{name}") as stream:
        return json.loads(stream.read())


def last_state(root: str) -> dict | None:
    names = _listed(root)
    return _read(root, names[-1]) if names else None


def keep_state(root: str, number: int, state: dict) -> list[dict]:
    """Writes the state of this number and forgets those before the last two, which are returned: what they name may still be read."""
    fs, base = opened(root)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/next") as out:
        out.write(json.dumps(state).encode())
    fs.move(f"{base}/next", f"{base}/state-{number:09d}.json")
    names = _listed(root)
    for name in names[:-2]:
        fs.delete_file(f"{base}/{name}")
    return [_read(root, name) for name in names[-2:]]
