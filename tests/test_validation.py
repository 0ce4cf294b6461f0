"""Settings checks: messages, counts and order."""

import pytest

from wharfline.operators import validation as v

GOOD = {
    "bootstrapServer": "kafka:9092", "srcTopicName": "eq-src", "mapperTopicName": "eq-mapper-events",
    "targetTopicName": "eq-target-events", "orgName": "quay", "schemaType": "eq", "productType": "gas",
    "SERVICE_NAME": "svc", "SERVICE_VERSION": "0.0.1",
}


def errors(spark, check, **changes):
    config = {k: x for k, x in {**GOOD, **changes}.items() if x is not None}
    return check(spark.createDataFrame([("c", "k", config)], "component string, kind string, config map<string,string>")).first().errors


def test_cloud(spark):
    azure = {f: "QUJD" for f in v.AZURE_FIELDS}
    assert errors(spark, v.validate_cloud, cloudProviderType=" Azure ", **azure) == []
    bad = errors(spark, v.validate_cloud, cloudProviderType="azure", srcConnectionString=" ", mapperConnectionString="abc")
    assert bad == [
        "[azure] 'srcConnectionString' is required but empty",
        "[azure] 'mapperConnectionString' is not valid base64",
        "[azure] 'targetConnectionString' is required but empty",
    ]
    assert len(errors(spark, v.validate_cloud, cloudProviderType="aws")) == 4
    assert errors(spark, v.validate_cloud, cloudProviderType="gcp") == [
        "Unknown cloudProviderType 'gcp'. Expected 'azure' or 'aws'"
    ]
    only_source = lambda df: v.validate_cloud(df, ["srcConnectionString"])
    assert len(errors(spark, only_source, cloudProviderType="azure")) == 1


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, []),
        ({"bootstrapServer": ""}, ["[kafka] 'bootstrapServer' is required but empty"]),
        ({"bootstrapServer": "host"}, ["[kafka] invalid bootstrap entry 'host' (expected host:port)"]),
        (
            {"bootstrapServer": "a:1, b"},
            ["[kafka] 'bootstrapServer' must not contain spaces", "[kafka] invalid bootstrap entry ' b' (expected host:port)"],
        ),
        ({"mapperTopicName": " ", "targetTopicName": None},
         ["[kafka] 'mapperTopicName' is required but empty", "[kafka] 'targetTopicName' is required but empty"]),
        ({"mapperTopicName": " edge "}, []),
    ],
)
def test_kafka(spark, changes, expected):
    assert errors(spark, v.validate_kafka, **changes) == expected


def test_adaptor(spark):
    assert errors(spark, v.validate_adaptor) == []
    assert errors(spark, v.validate_adaptor, SERVICE_VERSION="invalid") == [
        "[adaptor] 'SERVICE_VERSION' must follow format X.Y.Z"
    ]
    assert errors(spark, v.validate_adaptor, bootstrapServer="") == ["[adaptor] 'bootstrapServer' is required but empty"] * 2
    assert errors(spark, v.validate_adaptor, orgName=" quay", srcTopicName=" a b", mapperTopicName="") == [
        "[adaptor] 'orgName' must not have leading/trailing spaces",
        "[adaptor] 'srcTopicName' must not have leading/trailing spaces",
        "[adaptor] 'srcTopicName' must not contain spaces",
    ]
    assert len(errors(spark, v.validate_adaptor, **{k: None for k in GOOD})) == 8


def test_mapper(spark):
    assert errors(spark, v.validate_mapper, mapperTopicName=None, targetTopicName="a b") == [
        "[schema-mapper] 'mapperTopicName' is required but empty",
        "[schema-mapper] 'targetTopicName' must not contain spaces",
    ]


def test_consumer(spark):
    extractor = lambda df: v.validate_consumer(df, "extractor")
    mapper = lambda df: v.validate_consumer(df, "schema-mapper")
    assert errors(spark, extractor) == [] and errors(spark, mapper) == []
    assert errors(spark, extractor, bootstrapServer=None, srcTopicName=None) == [
        "[extractor] 'bootstrapServer' is required",
        "[extractor] 'srcTopicName' is required",
        "[extractor] 'bootstrapServer' is required",
    ]
    assert errors(spark, mapper, mapperTopicName=" x") == [
        "[schema-mapper] 'mapperTopicName' has leading/trailing spaces",
        "[schema-mapper] 'mapperTopicName' must not contain spaces",
    ]


def test_report(spark):
    df = spark.createDataFrame(
        [("a", "kafka", {}), ("b", "adaptor", GOOD), ("c", "consumer-extractor", {})],
        "component string, kind string, config map<string,string>",
    )
    rows = {r.component: r for r in v.validation_report(v.validate_by_kind(df), "component").collect()}
    assert set(rows) == {"a", "c"} and rows["a"].error_count == 3
    assert rows["a"].summary == "KAFKA configuration validation failed"
    assert rows["c"].summary == "EXTRACTOR validation failed:"
    assert v.error_rows(v.validate_by_kind(df), "component").count() == 6
