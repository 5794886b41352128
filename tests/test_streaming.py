import os
import time

from tabulon.plans.ingest import ingest
from tabulon.sinks.tables import TableStore
from tabulon.streaming import start_arrivals

from core_helpers import local_dir
from test_ingest import FILES, SPEC, write


def test_arrivals_one_file_per_batch_equal_batch_ingest(spark, scratch):
    d = local_dir(scratch + "/in")
    for i, (name, text) in enumerate(sorted(FILES.items())):
        write(d, name, text)
        os.utime(os.path.join(d, name), (time.time() - 100 + i, time.time() - 100 + i))
    batch = TableStore(spark, scratch + "/batch", register=False)
    ingest(batch, SPEC, scratch + "/in")
    streamed = TableStore(spark, scratch + "/stream", register=False)
    q = start_arrivals(spark, SPEC, scratch + "/in", streamed, files_per_batch=1,
                       checkpoint=scratch + "/ckpt")
    q.awaitTermination()
    assert q.exception() is None
    assert streamed.current_version("ing") == 3  # empty master + one version per file
    assert sorted(map(tuple, streamed.read("ing").collect())) == sorted(map(tuple, batch.read("ing").collect()))
    assert streamed.ledger("ing").count() == 3
