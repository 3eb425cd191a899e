import pytest

from cdclake.config import CdcConfig, TriggerPolicy, config_subset, select_trigger_policy


def test_config_subset_strips_prefix():
    props = {"debezium.sink.sparkbatch.spark.master": "local[2]", "debezium.sink.sparkbatch.save-format": "orc",
             "debezium.sink.other": "x", "debezium.sink.sparkbatch.": "empty"}
    assert config_subset(props, "debezium.sink.sparkbatch.") == {"spark.master": "local[2]", "save-format": "orc"}


def test_from_properties_defaults_and_overrides():
    cfg = CdcConfig.from_properties({})
    assert (cfg.base_path, cfg.save_format, cfg.save_mode, cfg.cast_deleted_field) == (
        "s3a://My-S3-Bucket", "parquet", "append", False)
    assert cfg.partition is False and cfg.partition_tz == "UTC" and cfg.prefix == ""
    cfg = CdcConfig.from_properties({
        "debezium.sink.sparkbatch.bucket-name": "s3a://b", "debezium.sink.sparkbatch.save-format": "json",
        "debezium.sink.sparkbatch.cast-deleted-field": "true", "debezium.sink.batch.objectkey-partition": "true",
        "debezium.sink.batch.objectkey-prefix": "raw_", "debezium.sink.batch.destination-regexp": "^testc\\.",
        "debezium.sink.batch.destination-regexp-replace": "", "debezium.sink.batch.batch-size-wait": "MaxBatchSizeWait",
        "debezium.source.max.batch.size": "5000", "debezium.sink.batch.batch-size-wait.max-wait-ms": "5000"})
    assert cfg.base_path == "s3a://b" and cfg.save_format == "json" and cfg.cast_deleted_field
    assert cfg.partition and cfg.prefix == "raw_" and cfg.dest_regexp == "^testc\\."
    assert cfg.trigger.name == "MaxBatchSizeWait" and cfg.trigger.max_batch_size == 5000


def test_only_json_formats():
    with pytest.raises(ValueError):
        CdcConfig.from_properties({"debezium.format.value": "avro"})


def test_unknown_policy_name_fails():
    with pytest.raises(ValueError):
        select_trigger_policy("SleepForever")


def test_policy_options():
    assert TriggerPolicy().trigger_kwargs() == {"processingTime": "0 seconds"}
    assert TriggerPolicy(available_now=True).trigger_kwargs() == {"availableNow": True}
    p = select_trigger_policy("MaxBatchSizeWait", max_batch_size=2048, max_wait_ms=5000)
    assert p.source_options("kafka") == {"minOffsetsPerTrigger": "2048", "maxOffsetsPerTrigger": "2048",
                                         "maxTriggerDelay": "5000ms"}
    assert TriggerPolicy(max_files_per_trigger=3).source_options("json") == {"maxFilesPerTrigger": "3"}


class _FakeContext:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _FakeSession:
    def __init__(self, master):
        self.sparkContext = _FakeContext(master)
        self.conf = type("Conf", (), {"get": staticmethod(lambda k, default=None: default)})()


def test_shared_dir_fallback_only_in_local_mode():
    import pytest

    from cdclake.config import shared_dir

    local = _FakeSession("local[4]")
    d = shared_dir(local)
    assert d and local.sparkContext.dir == d and shared_dir(local) == d  # registered once, then reused
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_FakeSession("yarn"))
