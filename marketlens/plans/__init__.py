"""Reports composed from the operators: finance, merch, compliance, cohort."""
