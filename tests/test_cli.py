import json

import pytest

from cairn import cli
from test_sources import export


def test_harvest_build_query(spark, tmp_path, capsys):
    registry = tmp_path / "registry"
    (registry / "spain").mkdir(parents=True)
    source = {"id": "s", "name": "S", "protocol": "local", "endpoint": "e", "rights_note": "r"}
    (registry / "spain" / "manifest.json").write_text(json.dumps({"id": "spain", "name": "Spain", "language": "es", "language_name": "x", "native_query_default": "q", "publication_cutoff": 1929, "cutoff_note": "", "sources": [source]}))
    root = tmp_path / "export"
    root.mkdir()
    out, index = str(tmp_path / "corpus"), str(tmp_path / "index")
    assert cli.main(["list-sources", str(registry)]) == 0
    assert cli.main(["harvest", str(registry), "spain", "s", export(root), out]) == 0
    assert cli.main(["build", out, index, "--country", "spain"]) == 0
    assert cli.main(["query", index, "historia pueblo", "--top-k", "2"]) == 0
    assert cli.main(["query", index, "historia", "--prompt"]) == 0
    assert cli.main(["derive-plan", out, "spain", "es"]) == 0
    assert cli.main(["audit", out, "--report", str(tmp_path / "r.json")]) == 0
    assert json.loads((tmp_path / "r.json").read_text())["periods"] == [{"period": "1880-1909", "count": 3}]
    assert cli.main(["harvest", str(registry), "spain", "s", export(root), str(tmp_path / "more"), "--append", "--limit", "2"]) == 0
    (tmp_path / "tei").mkdir()
    (tmp_path / "tei" / "a.xml").write_text("<TEI><title>Poems</title><term>Poetry</term><p>x</p></TEI>")
    assert cli.main(["review", str(tmp_path / "tei"), str(tmp_path / "r.csv")]) == 0
    with pytest.raises(ValueError, match="no collector"):
        cli.main(["harvest", str(registry), "spain", "s", "-", out])
    with pytest.raises(RuntimeError, match="execute"):
        cli.main(["derive", out, "spain", "es", str(tmp_path / "run"), str(tmp_path / "derived"), "m", "i"])
    text = capsys.readouterr().out
    assert '"added": 2' in text and '"listed": 1' in text and '"status": "enabled"' in text and '"chunks": 3' in text and "Historia del pueblo" in text and "QUESTION:\nhistoria" in text and '"documents": 3' in text and '"period": "1880-1909"' in text


def test_collect(spark, tmp_path, capsys):
    (tmp_path / "tei").mkdir()
    for k in (2, 1, 3):
        (tmp_path / "tei" / f"N{k}.xml").write_text(f"<TEI><title>Report {k}</title><p>{'words of it ' * 20}</p></TEI>")
    out = str(tmp_path / "out")
    assert cli.main(["collect", "evans", out, "--root", str(tmp_path / "tei"), "--limit", "2"]) == 0
    assert sorted(r.id for r in spark.read.json(out).collect()) == ["evans:N1", "evans:N2"]
    assert cli.main(["collect", "evans-tcp", out, "--root", str(tmp_path / "tei"), "--append"]) == 0
    assert '"added": 3' in capsys.readouterr().out and spark.read.json(out).count() == 5
    with pytest.raises(ValueError, match="unknown source"):
        cli.main(["collect", "nothing", out])
