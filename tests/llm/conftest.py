import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
for folder in (os.path.dirname(HERE), os.path.dirname(os.path.dirname(HERE))):
    if folder not in sys.path:
        sys.path.insert(0, folder)
