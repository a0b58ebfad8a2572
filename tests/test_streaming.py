import os

from tillroll.streaming import start_line_split

HEADER = "orderId,customerId,productId,quantity,unitPrice,country,orderDate"


def _write(path, lines):
    tmp = path + ".tmp"
    with open(tmp, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.rename(tmp, path)  # appear atomically to the file source


def test_incremental_split(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    acc, rej, ckpt = (os.path.join(scratch, x) for x in ("accepted", "rejected", "ckpt"))
    _write(f"{src}/a.csv", [HEADER, "L20,K4,A11,6,18.25,Chile,2022-11-30", "L21,K5,A12,one,640.0,Kenya,2022-11-30"])
    _write(f"{src}/b.csv", [HEADER, "L22,K6,A10,2,120.5,Kenya,2022-12-01", ""])
    q = start_line_split(spark, src, acc, rej, checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(acc).count() == 2
    assert [r.line for r in spark.read.parquet(rej).collect()] == ["L21,K5,A12,one,640.0,Kenya,2022-11-30"]

    # a second run picks up only the new file
    _write(f"{src}/c.csv", ["L23,K6,A10", "L24,K7,A11,5,19.0,Chile,2022-12-04"])
    q = start_line_split(spark, src, acc, rej, checkpoint=ckpt)
    q.awaitTermination(120)
    assert sorted(r.order_id for r in spark.read.parquet(acc).collect()) == ["L20", "L22", "L24"]
    assert spark.read.parquet(rej).count() == 2
