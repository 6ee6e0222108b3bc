import subprocess

import pytest

from gridloom.config import ArchiveConfig
from gridloom.operators import provenance

KEY = """# key

| original_variable_name | original_units | canonical_name | canonical_units | canonical_long_name | unit_conversion |
| --- | --- | --- | --- | --- | --- |
| `rain` | `mm/d` | `precipitation` | `mm d-1` | precipitation | none |

| original_frequency_name | canonical_name | canonical_long_name |
| --- | --- | --- |
| `daily` | `day` | daily average |
"""


def test_names_and_units_come_from_the_key(spark, tmp_path):
    (tmp_path / "key.md").write_text(KEY)
    config = ArchiveConfig(download="/d", version="V1.0", product="Past/Daily", variable="rain", key=str(tmp_path / "key.md"))
    found = provenance.nomenclature(spark, config, "mm/d")
    assert (found["variable_name"], found["units"], found["original_units"], found["temporal_frequency"]) == ("precipitation", "mm d-1", "mm/d", "day")
    assert found["unit_conversion"] == "none: mm/d and mm d-1 are one unit"
    assert provenance.nomenclature(spark, config, "mm d-1")["unit_conversion"] == "none"
    with pytest.raises(ValueError):
        provenance.nomenclature(spark, ArchiveConfig(download="/d", version="V1.0", product="Past/Daily", variable="snow", key=config.key), "mm")


def test_evidence_is_the_last_complete_run(spark, tmp_path):
    log = tmp_path / "verify.log"
    log.write_text(
        "start\nINFO phases: ['structure', 'index']\nINFO 5 checks, 0 failures\nstore verified\n"
        "INFO phases: ['structure', 'index']\nINFO 6 checks, 0 failures\nstore verified\n"
        "INFO phases: ['structure']\nINFO 2 checks, 0 failures\nstore verified\nINFO phases: ['structure', 'index']\nINFO 6 checks, 1 failures\n"
    )
    assert provenance.log_runs(spark, str(log)).count() == 4
    found = provenance.log_evidence(spark, str(log), ["structure", "index"])
    assert (found["run"], found["n_checks"]) == (2, 6)
    with pytest.raises(PermissionError):
        provenance.log_evidence(spark, str(log), ["structure", "index", "sweep"])


def test_files_are_counted_by_folder(spark, tmp_path):
    for name in ("a/1.bin", "a/2.bin", "b/c/3.bin"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"xyz")
    found = {r["folder"].rsplit("/", 1)[1]: (r["n_files"], r["n_bytes"]) for r in provenance.object_counts(spark, str(tmp_path)).collect()}
    assert found == {"a": (2, 6), "c": (1, 3)}


def test_revision(tmp_path):
    assert provenance.code_revision(str(tmp_path)) == "unknown"
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)
    git("init")
    (tmp_path / "f").write_text("x")
    git("add", "f")
    git("commit", "-m", "x")
    assert len(provenance.code_revision(str(tmp_path))) >= 7
    (tmp_path / "f").write_text("y")
    assert provenance.code_revision(str(tmp_path)).endswith("-dirty")
