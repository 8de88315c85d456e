"""Layouts of the inputs, as declared schemas."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column names and types of the inputs, in file order.
POLICY = _struct(
    IssuerId=T.IntegerType(),
    IssuerId2=T.IntegerType(),
    BusinessDate=T.DateType(),
    StateCode=T.StringType(),
    SourceName=T.StringType(),
    NetworkName=T.StringType(),
    NetworkURL=T.StringType(),
    custnum=T.StringType(),
    MarketCoverage=T.StringType(),
    DentalOnlyPlan=T.StringType(),
)
CUSTOMER = _struct(
    custcode=T.StringType(),
    custname=T.StringType(),
    lname=T.StringType(),
    age=T.StringType(),
    proffession=T.StringType(),
)
STATE = _struct(statecode=T.StringType(), statedesc=T.StringType())
CATEGORY = _struct(
    category_id=T.IntegerType(),
    category_department_id=T.IntegerType(),
    category_name=T.StringType(),
)
PRODUCT = _struct(
    product_id=T.IntegerType(),
    product_category_id=T.IntegerType(),
    product_name=T.StringType(),
)
ORDER_ITEM = _struct(
    order_item_id=T.IntegerType(),
    order_item_order_id=T.IntegerType(),
    order_item_product_id=T.IntegerType(),
    order_item_quantity=T.IntegerType(),
    order_item_subtotal=T.IntegerType(),
    order_item_product_price=T.IntegerType(),
)
VISIT = _struct(
    results=T.ArrayType(
        _struct(
            login=_struct(username=T.StringType()),
            cell=T.StringType(),
            name=_struct(first=T.StringType()),
            dob=_struct(age=T.IntegerType(), date=T.StringType()),
            email=T.StringType(),
            location=_struct(
                city=T.StringType(),
                state=T.StringType(),
                country=T.StringType(),
                coordinates=_struct(latitude=T.StringType(), longitude=T.StringType()),
                timezone=_struct(offset=T.StringType(), description=T.StringType()),
            ),
        )
    )
)

POLICY_FIELDS = POLICY.fieldNames()

# Mixed customer / state file: wide enough for both shapes, all text.
MIXED = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(5)])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus a column that receives records that do not fit it."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
