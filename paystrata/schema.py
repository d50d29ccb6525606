"""The record contract: column names, types and source positions."""

from __future__ import annotations

from pyspark.sql import types as T

# The 75 columns of the source file, in file order.
_LEADING_COLUMNS = """
Change_Type
Covered_Recipient_Type
Teaching_Hospital_CCN
Teaching_Hospital_ID
Teaching_Hospital_Name
Physician_Profile_ID
Physician_First_Name
Physician_Middle_Name
Physician_Last_Name
Physician_Name_Suffix
Recipient_Primary_Business_Street_Address_Line1
Recipient_Primary_Business_Street_Address_Line2
Recipient_City
Recipient_State
Recipient_Zip_Code
Recipient_Country
Recipient_Province
Recipient_Postal_Code
Physician_Primary_Type
Physician_Specialty
Physician_License_State_code1
Physician_License_State_code2
Physician_License_State_code3
Physician_License_State_code4
Physician_License_State_code5
Submitting_Applicable_Manufacturer_or_Applicable_GPO_Name
Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_ID
Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name
Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_State
Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Country
Total_Amount_of_Payment_USDollars
Date_of_Payment
Number_of_Payments_Included_in_Total_Amount
Form_of_Payment_or_Transfer_of_Value
Nature_of_Payment_or_Transfer_of_Value
City_of_Travel
State_of_Travel
Country_of_Travel
Physician_Ownership_Indicator
Third_Party_Payment_Recipient_Indicator
Name_of_Third_Party_Entity_Receiving_Payment_or_Transfer_of_Value
Charity_Indicator
Third_Party_Equals_Covered_Recipient_Indicator
Contextual_Information
Delay_in_Publication_Indicator
Record_ID
Dispute_Status_for_Publication
Related_Product_Indicator
""".split()
_PRODUCT_COLUMNS = """
Covered_or_Noncovered_Indicator
Indicate_Drug_or_Biological_or_Device_or_Medical_Supply
Product_Category_or_Therapeutic_Area
Name_of_Drug_or_Biological_or_Device_or_Medical_Supply
Associated_Drug_or_Biological_NDC
""".split()

CSV_COLUMNS: list[str] = (
    _LEADING_COLUMNS
    + [f"{name}_{n}" for n in range(1, 6) for name in _PRODUCT_COLUMNS]
    + ["Program_Year", "Payment_Publication_Date"]
)
CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS])
# Where a reader puts the text of a row that does not fit its columns.
CORRUPT = "_corrupt_record"

# Record field -> source column. The amount and the key are handled apart.
SOURCE_NAMES: dict[str, str] = {
    "physician_id": "Physician_Profile_ID",
    "date_payment": "Date_of_Payment",
    "record_id": "Record_ID",
    "payer": "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name",
    "amount": "Total_Amount_of_Payment_USDollars",
    "physician_specialty": "Physician_Specialty",
    "nature_of_payment": "Nature_of_Payment_or_Transfer_of_Value",
    "physician_name_first": "Physician_First_Name",
    "physician_name_middle": "Physician_Middle_Name",
    "physician_name_last": "Physician_Last_Name",
    "physician_name_suffix": "Physician_Name_Suffix",
    "recipient_city": "Recipient_City",
    "recipient_state": "Recipient_State",
    "recipient_zip": "Recipient_Zip_Code",
    "recipient_country": "Recipient_Country",
}
SOURCE_POSITIONS: dict[str, int] = {
    field: CSV_COLUMNS.index(name) for field, name in SOURCE_NAMES.items()
}
# A line must reach the last position that is read.
MIN_FIELDS = max(SOURCE_POSITIONS.values()) + 1

PAYMENT_COLUMNS: list[str] = ["_id"] + [f for f in SOURCE_NAMES if f != "record_id"]
PAYMENT_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c == "amount" else T.StringType())
        for c in PAYMENT_COLUMNS
    ]
)
NARROW_SCHEMA = T.StructType(PAYMENT_SCHEMA.fields[:7])

# Grain of the report view.
REPORT_DIMENSIONS = [
    "recipient_country",
    "recipient_state",
    "physician_specialty",
    "recipient_zip",
    "payer",
    "nature_of_payment",
]
