"""The command line runs the jobs end to end on the XML fixtures."""

import os

from test_xml_pipelines import inputs  # noqa: F401  (fixture)

from trainyard.__main__ import main


def test_cli_end_to_end(spark, inputs, tmp, capsys):  # noqa: F811
    p, c, sj = inputs
    star = os.path.join(tmp, "star")
    mv = os.path.join(tmp, "mv")
    main(["star-load", "--plans", p, "--changes", c, "--stations", sj,
          "--out", star])
    main(["lake", "--plans", p, "--changes", c, "--out", mv])
    main(["analyze", "--movements", mv, "--station",
          "Berlin Alexanderplatz"])
    main(["lookup", "--star", star, "--text", "alex"])
    main(["nearest", "--star", star, "--lat", "52.52", "--lon", "13.40"])
    main(["cancelled", "--star", star, "--snapshot", "2509021200"])
    main(["avg-delay", "--star", star, "--text", "berlin"])
    main(["hops", "--star", star, "A:B", "C:D", "D:C"])
    main(["stations", "--star", star])
    main(["stations", "--star", star, "--graph"])
    main(["earliest", "--star", star, "--departure", "2025-09-02 12:00:00",
          "Berlin Hbf:Berlin Hbf"])
    out = capsys.readouterr().out
    assert "Berlin Alexanderplatz" in out and "cancelled_trains" in out
    assert "C → D" in out          # only departure paths form the graph
    assert "source not found" in out and "no path" in out
    assert "stations\tconnections\n2\t1" in out
