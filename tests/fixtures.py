"""Small inputs whose answers are known by hand."""

EMPLOYEES = [
    (1, "Alice", "Engineering", 95000.0, "US"),
    (2, "Bob", "Marketing", 72000.0, "US"),
    (3, "Carol", "Engineering", 88000.0, "UK"),
    (4, "Dave", "HR", 65000.0, "US"),
    (5, "Eve", "Engineering", 105000.0, "DE"),
    (6, "Frank", "Marketing", 78000.0, "UK"),
    (7, "Grace", "HR", 68000.0, "US"),
    (8, "Heidi", "Engineering", 92000.0, "DE"),
    (9, "Ivan", "Marketing", 75000.0, "US"),
    (10, "Judy", "Engineering", 98000.0, "UK"),
]
EMPLOYEE_SCHEMA = "emp_id bigint, name string, department string, salary double, country string"

DEPARTMENTS = [
    ("Engineering", "Technology", "San Francisco"),
    ("Marketing", "Business", "New York"),
    ("HR", "Operations", "Chicago"),
    ("Finance", "Business", "New York"),
]
