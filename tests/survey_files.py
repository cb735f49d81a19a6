"""A small survey on disk: sets of uncompressed image files, calibration, GPS and heading."""

import numpy as np

COLUMNS = 1536


def image(heights: np.ndarray) -> bytes:
    rows = np.zeros(len(heights), np.dtype([("header", "S8"), ("intensity", "u1", (heights.shape[1],)), ("heights", "<u2", (heights.shape[1],))]))
    rows["header"] = b"HEADER01"
    rows["intensity"] = np.arange(heights.shape[1]) % 256
    rows["heights"] = heights[:, ::-1]
    body = rows.tobytes()
    return b"\x46" + (len(body) + 9).to_bytes(4, "little") + len(body).to_bytes(4, "little") + body


def surface(n: int, depth: float = 300.0) -> np.ndarray:
    """Raw heights of a crowned lane with a dip in each wheel path."""
    x = np.arange(COLUMNS) * 162.0 / COLUMNS
    dip = sum(np.exp(-0.5 * ((x - c) / 6.0) ** 2) for c in (46.55, 115.45))
    return np.tile(np.rint(2000 + 0.5 * x - depth * dip), (n, 1)).astype("<u2")


def calibration(columns: int = COLUMNS) -> str:
    return "3D_Camera_Calibration " + " ".join(["0"] * columns) + " 30 8 82 162 0.03 0.03 80 0.5 2020 1 2 3 4"


def make_set(root, set_id: str, frames: int = 3, rows: int = 4, depth: float = 300.0):
    folder = root / set_id / "93"
    folder.mkdir(parents=True)
    (root / set_id / "3D_Camera.cal").write_text(calibration())
    for k in range(frames):
        (folder / f"1120133{k:02d}04C.3dc").write_bytes(image(surface(rows, depth)))
    (root / set_id / f"gpsdis.{set_id}").write_text("167400 35 -78 0\nbad row\n167410 36 -79 0\n167500 37 -80 0\n")
    (root / set_id / f"heading.{set_id}").write_text("167400 10\n167410 20\n167500 30\n")
    return root / set_id
