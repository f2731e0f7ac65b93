"""Data products: bronze inputs (mapping), silver tables, gold views."""
