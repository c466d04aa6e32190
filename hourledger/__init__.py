"""hourledger: timesheets to validated invoices, as Spark DataFrame plans."""
