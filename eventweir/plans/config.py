"""Driver-side settings and small files: reading, merging and adapting configurations, progress, moving and counting files.

Files are reached through Hadoop's file systems, so a path may be local or shared.
"""

from __future__ import annotations

import copy
import json
import shlex
import sys
from datetime import datetime, timezone
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, replaced as a whole."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())  # one small file


def load(spark: SparkSession, path: str) -> dict:
    """A JSON document, or a YAML one where PyYAML is there; an empty file is an empty configuration, anything but a mapping an error."""
    text = read_text(spark, path)
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError(f"{path}: PyYAML is needed for YAML files") from e
        doc = yaml.safe_load(text)
    else:
        doc = json.loads(text) if text.strip() else None
    if doc is None:
        return {}
    if not isinstance(doc, dict):
        raise ValueError(f"{path}: a mapping is needed")
    return doc


def write_json(spark: SparkSession, path: str, doc: Any) -> None:
    write_text(spark, path, json.dumps(doc, indent=2, ensure_ascii=False, sort_keys=True) + "\n")


def write_yaml(spark: SparkSession, path: str, doc: Any) -> None:
    """YAML where PyYAML is there; else JSON, which YAML readers read too."""
    try:
        import yaml
    except ImportError:
        return write_json(spark, path, doc)
    return write_text(spark, path, yaml.safe_dump(doc, allow_unicode=True, sort_keys=True))


def merged(base: dict, override: dict) -> dict:
    """base with override's values, mapping by mapping; what override leaves null stays as it was. Neither is changed."""
    out = copy.deepcopy(base)
    for k, v in override.items():
        if isinstance(v, dict) and isinstance(out.get(k, {}), dict):
            out[k] = merged(out.get(k) or {}, v)
        elif v is not None:
            out[k] = copy.deepcopy(v)
    return out


def min_events_for(min_events: int, lengths: list[int]) -> int:
    """The least number of events a stream may have, lowered to the shortest calibrated length if that is less."""
    return min([min_events, *lengths])


def as_list(value: Any) -> list[str]:
    """A list of strings from a list, a text with commas, one value or nothing."""
    if value is None or value == "":
        return []
    if isinstance(value, str):
        return [x.strip() for x in value.split(",") if x.strip()]
    if isinstance(value, (list, tuple, set)):
        return [str(x) for x in value]
    return [str(value)]


def optional_int(value: Any) -> int | None:
    return None if value in (None, "") else int(value)


def domain_of(config: dict, path: str) -> str:
    """The domain a calibration is about: as configured, else the input's name without its endings."""
    return str(config.get("domain") or PurePosixPath(path).name.split(".")[0] or "calibrated")


def resolved(path: str, folder: str) -> str:
    """path as it is if absolute or with a scheme, else under folder."""
    return path if path.startswith("/") or "://" in path else f"{folder.rstrip('/')}/{path}"


def write_progress(spark: SparkSession, path: str | None, status: str, total: int, accepted: int, rejected: int) -> None:
    if path is not None:
        now = datetime.now(timezone.utc).isoformat()
        write_json(spark, path, {"status": status, "total": total, "completed": accepted + rejected, "accepted": accepted, "rejected": rejected, "updated_at": now})


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines of a text file or folder that aren't blank; none if there is no such path."""
    return spark.read.text(path).where("trim(value) <> ''").count() if exists(spark, path) else 0


def move_or_touch(spark: SparkSession, source: str, target: str) -> bool:
    """Moves source over target if it is there, else leaves an empty target; whether it was there."""
    (a, fs), (b, to) = _fs(spark, source), _fs(spark, target)
    if not fs.exists(a):
        write_text(spark, target, "")
        return False
    if to.exists(b):
        to.delete(b, True)
    if not fs.rename(a, b):
        raise OSError(f"{source} can't be moved to {target}")
    return True


def entry_command(argv: list[str] | None = None) -> str:
    return shlex.join(["python", "-m", "eventweir.plans.cli", *(sys.argv[1:] if argv is None else argv)])
