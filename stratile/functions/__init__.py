"""Column functions: text and paths, boxes, geodesy, index arithmetic. All are built-in expressions."""
