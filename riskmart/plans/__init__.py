"""Domain plans composed from the operators: marts, scores, IFRS 9, reports."""
