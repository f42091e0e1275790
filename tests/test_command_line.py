from __future__ import annotations

from courierlens.__main__ import REPORTS, main


def test_build_show_and_flow(spark, tmp_path, capsys):
    star, out = str(tmp_path / "star"), str(tmp_path / "out")
    main(["build", star, "--orders", "500", "--captains", "20", "--restaurants", "10", "--csv"])
    assert "cancelled_pct" in capsys.readouterr().out
    main(["show", star])
    shown = capsys.readouterr().out
    assert all(name in shown for name in REPORTS)
    main(["show", star, "--layout", "landing", "--names", "report_overview"])
    assert "500" in capsys.readouterr().out
    main(["flow", star, out, "--no-models"])
    assert "mart_zone_analysis\t" in capsys.readouterr().out
