"""DataFrame operators: line parsing, attempt reconstruction, questions,
failure classification, reports and the aggregation / join workloads."""
