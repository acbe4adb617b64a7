"""Risk data mart on Spark: cleaning, validation, repair, star schema, risk scores and IFRS 9 as DataFrame operators."""
