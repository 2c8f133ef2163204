import os

from gridlake.__main__ import main


def test_cli_load_convert_and_sql(spark, tmp, capsys):
    os.makedirs(f"{tmp}/b/rides")
    with open(f"{tmp}/b/rides/rides.csv", "w") as f:
        f.write("ride_id,started_at,station\nr1,2023-05-01 10:00:00,A\nr1,2023-06-01 10:00:00,B\n")
    assert main(["load-bucket", f"{tmp}/b", "--database", "cli_raw"]) == 0
    assert main(["sql", "SELECT station FROM cli_raw.rides"]) == 0
    assert "|B" in capsys.readouterr().out.replace(" ", "")
    assert main(["convert", f"{tmp}/b", f"{tmp}/out"]) == 0
    assert os.path.isdir(f"{tmp}/out/inputs/rides.parquet")
    assert main(["export", f"{tmp}/exported", "--databases", "cli_raw"]) == 0
    assert main(["import", f"{tmp}/exported"]) == 0
    assert spark.sparkContext._jsc is not None  # the shared session is still alive
