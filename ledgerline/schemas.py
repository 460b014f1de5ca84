"""Schemas of the four raw lending relations and the published tables.

Raw CSV files are read positionally with these schemas (header line skipped,
header names ignored); a malformed typed cell becomes NULL. The published
schemas are what the catalog tables over the cleaned CSV output declare.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: str) -> T.StructType:
    """Nullable columns in order (``StructType.fromDDL`` needs a session, which there is none of at import)."""
    schema = T.StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


# ---- fixed values: column names, order and types of the lending relations ----
RAW_CUSTOMERS = _struct(
    member_id="string", emp_title="string", emp_length="string", home_ownership="string",
    annual_income="string", address_state="string", address_zipcode="string", address_country="string",
    grade="string", sub_grade="string", verification_status="string", total_high_credit_limit="integer",
    application_type="string", join_annual_income="string", verification_status_joint="string")

RAW_LOANS = _struct(
    loan_id="string", member_id="string", loan_amount="float", funded_amount="float", loan_term_months="string",
    interest_rate="float", monthly_installment="float", issue_date="string", loan_status="string",
    loan_purpose="string", loan_title="string")

RAW_REPAYMENTS = _struct(
    loan_id="string", total_principal_received="float", total_interest_received="float",
    total_late_fee_received="float", total_payment_received="float", last_payment_amount="float",
    last_payment_date="string", next_payment_date="string")

RAW_DELINQUENCIES = _struct(
    member_id="string", delinq_2yrs="float", delinq_amnt="float", pub_rec="float", pub_rec_bankruptcies="float",
    inq_last_6mths="float", total_rec_late_fee="float", mths_since_last_delinq="float",
    mths_since_last_record="float")

PUBLISHED_CUSTOMERS = _struct(
    member_id="string", emp_title="string", emp_length="integer", home_ownership="string",
    annual_income="float", address_state="string", address_zipcode="string", address_country="string",
    grade="string", sub_grade="string", verification_status="string", total_high_credit_limit="float",
    application_type="string", join_annual_income="float", verification_status_joint="string",
    ingest_date="timestamp")

PUBLISHED_LOANS = _struct(
    loan_id="string", member_id="string", loan_amount="float", funded_amount="float", loan_term_years="integer",
    interest_rate="float", monthly_installment="float", issue_date="string", loan_status="string",
    loan_purpose="string", loan_title="string", ingest_date="timestamp")

PUBLISHED_REPAYMENTS = _struct(
    loan_id="string", total_principal_received="float", total_interest_received="float",
    total_late_fee_received="float", total_payment_received="float", last_payment_amount="float",
    last_payment_date="string", next_payment_date="string", ingest_date="timestamp")

PUBLISHED_DELINQUENCIES = _struct(
    member_id="string", delinq_2yrs="integer", delinq_amnt="float", mths_since_last_delinq="integer")

PUBLISHED_PUBLIC_RECORDS = _struct(
    member_id="string", pub_rec="integer", pub_rec_bankruptcies="integer", inq_last_6mths="integer")

# Header names used by the upstream customer export; the notebook renames them.
RAW_CUSTOMER_HEADER_RENAMES = {
    "annual_inc": "annual_income",
    "addr_state": "address_state",
    "zip_code": "address_zipcode",
    "country": "address_country",
    "tot_hi_cred_lim": "total_high_credit_limit",
    "annual_inc_joint": "join_annual_income",
}
# ---- end of fixed values ----

INGEST_COLUMN = "ingest_date"

PUBLISHED = {
    "customers": PUBLISHED_CUSTOMERS,
    "loans": PUBLISHED_LOANS,
    "repayments": PUBLISHED_REPAYMENTS,
    "delinquencies": PUBLISHED_DELINQUENCIES,
    "delinquencies_public_records": PUBLISHED_PUBLIC_RECORDS,
}


def ddl_columns(schema: T.StructType) -> str:
    """Column list for CREATE TABLE, e.g. ``member_id STRING, pub_rec INT``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
