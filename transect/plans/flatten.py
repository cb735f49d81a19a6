"""Previews in subfolders of older exports, moved to one folder, with the references in the exports."""

from __future__ import annotations

import re

import pyarrow.fs as pafs

from transect.plans.files import store, write_text

#: What an export of a set ends with.
OUTPUTS = (".csv", ".geojson", ".metadata.json")


def flatten_previews(root: str, apply: bool = False) -> dict:
    """Find previews/<folder>/x.png under root/set_*, and with apply move them to previews/x.png.

    Everything is checked first: RuntimeError for two files of one name, a name that is taken, or a nested preview that CSV
    or GeoJSON don't name exactly once. Files are copied, then the exports are rewritten, then the old files go; if copying
    fails, the copies go. Without apply nothing changes.
    """
    fs, top = store(root.rstrip("/"))
    nested: dict[str, dict[str, str]] = {}
    texts: dict[str, str] = {}
    for entry in sorted(fs.get_file_info(pafs.FileSelector(top)), key=lambda i: i.path):
        folder = f"{entry.path}/previews"
        if not entry.base_name.startswith("set_") or fs.get_file_info(folder).type != pafs.FileType.Directory:
            continue
        files = [i.path for i in fs.get_file_info(pafs.FileSelector(folder, recursive=True)) if i.is_file and i.path.endswith(".png")]
        deep = {p: f"{folder}/{p.rpartition('/')[2]}" for p in sorted(files) if p.count("/") > folder.count("/") + 1}
        if len(set(deep.values())) < len(deep) or set(deep.values()) & set(files):
            raise RuntimeError(f"names of previews collide under {folder}")
        if not deep:
            continue
        nested[folder] = deep
        wanted = sorted(p[len(entry.path) + 1 :] for p in deep)
        for output in fs.get_file_info(pafs.FileSelector(entry.path)):
            if output.is_file and output.base_name.endswith(OUTPUTS):
                with fs.open_input_file(output.path) as f:
                    text = f.read().decode()
                found = re.findall(r"previews/(?:[^/\"\\,\r\n]+/)+[^/\"\\,\r\n]+\.png", text)
                if output.base_name.endswith(OUTPUTS[:2]) and sorted(found) != wanted:
                    raise RuntimeError(f"{output.path} does not name each nested preview once")
                for p in found:
                    text = text.replace(p, f"previews/{p.rpartition('/')[2]}")
                texts[output.path] = text
    told = {"sets": len(nested), "previews": sum(map(len, nested.values())), "outputs": len(texts), "applied": apply}
    if not apply:
        return told
    made: list[str] = []
    try:
        for deep in nested.values():
            for old, new in deep.items():
                fs.copy_file(old, new)
                made.append(new)
    except BaseException:
        for p in made:
            fs.delete_file(p)
        raise
    for path, text in texts.items():
        write_text(path, text)
    for folder, deep in nested.items():
        for old in deep:
            fs.delete_file(old)
        for d in sorted((i.path for i in fs.get_file_info(pafs.FileSelector(folder, recursive=True)) if i.type == pafs.FileType.Directory), reverse=True):
            if not fs.get_file_info(pafs.FileSelector(d)):
                fs.delete_dir(d)
    return told
