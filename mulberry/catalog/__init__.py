"""Tables with engines, and changes of their definitions."""
